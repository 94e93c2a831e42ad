from zonewright.operators import names
from zonewright.operators.names import Suffixes
from zonewright.sources import tables

from pyspark.sql import functions as F

LIST = ["com", "uk", "co.uk", "au", "com.au", "ck", "*.ck", "!www.ck"]


def _normalized(spark, hosts):
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    out = names.normalize(names.suffix_of(df, "host", Suffixes.of(spark, LIST)), "host", Suffixes.of(spark, LIST))
    return {r["host"]: (r["suffix"], r["normalized"]) for r in out.collect()}


def test_suffix_and_normalize(spark):
    got = _normalized(spark, ["shop.com", "a.b.shop.com", "shop.co.uk", "x.shop.com.au", "com", "co.uk", "nowhere", "x.y.zz",
                              "www.ck", ".com", ""])
    assert got["shop.com"] == ("com", "shop.com")
    assert got["a.b.shop.com"] == ("com", "shop.com")
    assert got["shop.co.uk"] == ("co.uk", "shop.co.uk")
    assert got["x.shop.com.au"] == ("com.au", "shop.com.au")
    assert got["com"] == (None, None) and got["nowhere"] == (None, None) and got["x.y.zz"] == (None, None)
    assert got["co.uk"] == ("uk", "co.uk")  # a suffix never matches itself, a shorter one may
    assert got["www.ck"] == ("ck", "www.ck")  # rules are taken literally
    assert got[".com"][0] == "com"


def test_suffix_lines(spark):
    lines = spark.createDataFrame([("// note",), ("",), ("com ",), ("co.uk",)], "value string")
    s = Suffixes.from_table(tables.suffix_lines(lines))
    assert s.max_labels == 2 and {r[0] for r in s.table.collect()} == {"com", "co.uk"}


def test_normalize_list_and_rewrite(spark):
    s = Suffixes.of(spark, LIST)
    df = spark.createDataFrame([("a", ["ns2.x.com", "ns1.x.com", "ns.q.zz"]), ("b", []), ("c", None), ("d", ["zz"])],
                               "domain string, ns array<string>")
    got = {r["domain"]: r["ns_domains"] for r in names.normalize_list(df, "ns", s, ["domain"]).collect()}
    assert got == {"a": ["x.com"], "b": [], "c": [], "d": []}
    rows = spark.createDataFrame([("a", ["ns1.x.com", "ns2.y.com"]), ("b", ["y.com", "x.com"]), ("c", ["zz"]), ("d", []), ("e", None),
                                  ("f", ["x.com", "ns.q.zz"])], "domain string, ns_domains array<string>")
    got = {r["domain"]: r["ns_domains"] for r in names.normalise_ns_domains(rows, s).collect()}
    assert got == {"a": ["x.com", "y.com"], "b": ["x.com", "y.com"], "c": ["zz"], "d": [], "e": None, "f": ["x.com"]}


def test_audit_and_repair(spark):
    s = Suffixes.of(spark, LIST)
    df = spark.createDataFrame([("a.com", "com"), ("b.com.au", "au"), ("c.com", ""), ("d.com", None), ("e.zz", "com"), ("", "x")],
                               "domain string, tld string")
    audit = names.audit_tlds(df, s)
    got = sorted(map(tuple, audit.collect()))
    assert got == [("b.com.au", "au", "com.au"), ("d.com", "", "com")]
    fixed = {r["domain"]: r["tld"] for r in names.repair_tlds(df, audit).collect()}
    assert fixed == {"a.com": "com", "b.com.au": "com.au", "c.com": "", "d.com": "com", "e.zz": "com", "": "x"}


def test_rdap_unsupported(spark):
    got = {r[0] for r in names.rdap_unsupported(Suffixes.of(spark, LIST)).collect()}
    assert "com.au" in got and "us" in got and "com" not in got


def test_unicode_tlds(spark):
    df = spark.createDataFrame([("com",), ("xn--p1ai",), (None,), ("xn--ü",)], "tld string")
    got = [r["tld"] for r in names.unicode_tlds(df).collect()]
    assert sorted(map(str, got)) == sorted(["com", "рф", "None", "xn--ü"])


def test_suffix_join_has_no_shuffle(spark):
    df = spark.range(10).select(F.concat(F.lit("a"), F.col("id"), F.lit(".com")).alias("host"))
    plan = names.suffix_of(df, "host", Suffixes.of(spark, LIST))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
