import pytest
from pyspark.sql import functions as F

from zonewright.functions import criteria as cr
from zonewright.operators import search
from zonewright.operators.search import Page, Tag


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a_b.com", "com", 5, None, True, ["ns1.x.com", "ns2.x.com"], ["x.com"], [1, 2, 3]),
            ("axb.net", "net", None, "u1", False, [], [], None),
            ("c.com", "", 9, "u2", None, None, None, [4] * 12),
            ("d.com", "com", 9, "u1", None, [None, "ns1.y.com"], ["y.com"], [])]
    return spark.createDataFrame(data, "domain string, tld string, visits_12m bigint, pm_username string, registered boolean, "
                                       "ns array<string>, ns_domains array<string>, visits_arr_12m array<bigint>")


def names(df):
    return sorted(r["domain"] for r in df.collect())


@pytest.mark.parametrize("criteria,expected", [
    ([("tld", "exact", "com")], ["a_b.com", "d.com"]),
    ([("tld", "exact", "")], ["c.com"]),
    ([("pm_username", "not", "u1")], ["c.com"]),  # NULL is neither equal nor unequal
    ([("domain", "startswith", "a_")], ["a_b.com"]),  # no wildcards in values
    ([("domain", "substring", "%")], []),
    ([("visits_12m", "exact", "9")], ["c.com", "d.com"]),
    ([("visits_12m", "exact", "nine")], []),
    ([("ns", "exact", "ns1.y.com")], ["d.com"]),
    ([("ns", "not", "ns1.y.com")], ["a_b.com", "axb.net", "c.com"]),
    ([("ns", "startswith", "ns1.")], ["a_b.com", "d.com"]),
    ([("ns", "substring", ".x.")], ["a_b.com"]),
    ([("registered", "exact", "true")], ["a_b.com"]),
    ([("registered", "not", "true")], ["axb.net"]),
    ([("visits_arr_12m", "exact", "[1,2,3]")], ["a_b.com"]),
    ([("tld", "exact", "com"), ("ns_domains", "exact", "y.com")], ["d.com"]),
    ([], ["a_b.com", "axb.net", "c.com", "d.com"]),
])
def test_predicates(rows, criteria, expected):
    assert names(search.search(rows, criteria)) == expected


@pytest.mark.parametrize("bad", [("nosuch", "exact", "x"), ("tld", "like", "x"), ("registered", "exact", "yes"),
                                 ("visits_arr_12m", "substring", "1")])
def test_bad_criteria(rows, bad):
    with pytest.raises(ValueError):
        search.search(rows, [bad])


def test_snapshot_refine_and_refresh(rows, tmp_path, spark):
    path = str(tmp_path / "snap")
    search.write_snapshot(search.search(rows, [("tld", "exact", "com")]), path, 1)
    search.write_snapshot(rows, path, 2)
    search.write_snapshot(search.search(rows, [("tld", "exact", "com")]), path, 1)  # again: no doubles
    store = spark.read.parquet(path)
    assert names(search.read_snapshot(store, 1)) == ["a_b.com", "d.com"]
    assert names(search.refine(store, 1, [("visits_12m", "exact", "9")])) == ["d.com"]
    plan = search.refine(store, 1, [])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_id" in plan


def test_criteria_edits_and_text(spark):
    c = cr.check([("tld", "exact", "com"), ("domain", "substring", "x")])
    assert search.without_criterion(c, 0) == [("domain", "substring", "x")]
    assert search.changed_criterion(c, 1, ("ns", "exact", "y"))[1] == ("ns", "exact", "y")
    assert search.with_criterion(c, ("ns", "exact", "y"))[2].col == "ns"
    df = spark.createDataFrame([([tuple(x) for x in c],)], "criteria array<struct<col:string,match:string,value:string>>")
    assert df.select(cr.criteria_text(F.col("criteria"))).first()[0] == "tld exact com,domain substring x"


def test_page_order_and_nulls(rows):
    assert [r["domain"] for r in search.page(rows, Page("visits_12m", "desc", 10, 0)).collect()] == ["c.com", "d.com", "a_b.com", "axb.net"]
    assert [r["domain"] for r in search.page(rows, Page("visits_12m", "asc", 2, 2)).collect()] == ["d.com", "axb.net"]
    assert [r["domain"] for r in search.page_keyset(rows, "axb.net", 1).collect()] == ["c.com"]


def test_page_object():
    p = Page.parse("visits_12m/desc/50/0")
    assert p == Page("visits_12m", "desc", 50, 0) and p.to_string() == "visits_12m/desc/50/0"
    assert Page.parse(None) == Page()
    with pytest.raises(ValueError):
        Page(order="up")
    with pytest.raises(ValueError):
        Page(order_by="nosuch")
    with pytest.raises(ValueError):
        Page.parse("a/b")
    q = Page("domain", "asc", 50, 0, rows=70).next_page()
    assert q.offset == 50 and q.next_page().offset == 50
    assert Page("domain", "asc", 50, 50).previous_page().offset == 0
    assert Page("domain", "asc", 50, 0).previous_page().offset == 0
    assert p.change(order_by="registered").order_by == "registered"


def test_tags(rows):
    tags = [Tag(1, "one", "red", "i", (("tld", "exact", "com"),)), Tag(2, "two", "blue", "j", (("ns", "substring", ".x."),))]
    got = {r["domain"]: [t["name"] for t in r["tags"]] for r in search.tag_rows(rows, tags).collect()}
    assert got == {"a_b.com": ["one", "two"], "axb.net": [], "c.com": [], "d.com": ["one"]}
    assert all(r["tags"] == [] for r in search.tag_rows(rows, []).collect())


def test_load_tags(spark):
    tags = spark.createDataFrame([(7, 3, "n", "c", "i", None)], "id bigint, search_id bigint, name string, colour string, icon string, notes string")
    searches = spark.createDataFrame([(3, [("tld", "exact", "com")])], "id bigint, criteria array<struct<col:string,match:string,value:string>>")
    assert search.load_tags(tags, searches) == [Tag(7, "n", "c", "i", (("tld", "exact", "com"),))]


def test_facets(rows):
    assert [tuple(r) for r in search.facet(rows, "tld").collect()] == [("com", 2), ("<empty>", 1), ("net", 1)]
    assert [tuple(r) for r in search.facet(rows, "pm_username").collect()] == [("u1", 2), ("u2", 1)]
    under = [("ns_domains", "exact", "x.com")]
    assert [tuple(r) for r in search.facet(rows, "ns", under).collect()] == [("ns1.x.com", 1), ("ns2.x.com", 1)]
    assert [tuple(r) for r in search.top_n(rows, "pm_username", 2).collect()] == [("u1", 2), ("u2", 1)]


def test_summary(rows):
    s = search.summary(rows).first()
    assert s["count"] == 4 and [tuple(x) for x in s["registered"]] == [(False, 1), (True, 1), (None, 2)]
    assert s["visits_arr_12m"] == [5, 6, 7] + [4] * 9 and s["visits_12m"] == 54
    empty = search.summary(rows.where("false")).first()
    assert empty["count"] == 0 and empty["visits_12m"] == 0 and empty["visits_arr_12m"] == [0] * 12


@pytest.mark.parametrize("n", [1, 2, 3, 17, 99, 500])
@pytest.mark.parametrize("descending", [False, True])
def test_first_by_key_is_exact(spark, n, descending):
    keys = [f"{p}{i}" for p in ("a", "ab", "é", "z") for i in range(30)] + ["a", "ab", "z"]
    df = spark.createDataFrame([(k,) for k in keys], "domain string")
    got = sorted((r[0] for r in search.first_by_key(df, n, descending=descending, small=3).collect()), key=str.encode)
    order = sorted(keys, key=str.encode, reverse=descending)[:n]
    assert got == sorted(order, key=str.encode)


@pytest.mark.parametrize("n,named,nameless", [(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 2, 1), (5, 2, 2), (None, 2, 2)])
def test_rows_without_a_key_come_last(spark, n, named, nameless):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "domain string")
    got = [r[0] for r in search.first_by_key(df, n).collect()]
    assert (len([g for g in got if g]), got.count(None)) == (named, nameless)


def test_exports(rows, tmp_path, spark):
    search.export_csv(rows, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert back.count() == 4 and "ns" in back.columns
    assert back.where("domain = 'a_b.com'").first()["ns"] == "ns1.x.com,ns2.x.com"
    search.export_domains(rows, str(tmp_path / "txt"), cap=2)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "txt")).collect()) == ["a_b.com", "axb.net"]
