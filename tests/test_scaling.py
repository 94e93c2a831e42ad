"""Work is done once and shuffles move no more than they need: results with the plans or counts behind them."""

import json

import pytest
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.functions import text
from zonewright.operators import enrich, extract_whois, merge, names, ranks, skew
from zonewright.operators.names import Suffixes
from zonewright.operators.once import once
from zonewright.plans import catalog_layouts, catalog_updates
from zonewright.streaming import streams


def _counted(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        made.add(1)
        return True

    return made, seen.asNondeterministic()


def test_names_of_lists_are_gathered_before_the_shuffle(spark):
    rows = [("a", ["ns1.x.com", "ns2.x.com", "w.y.org", "z"]), ("b", []), ("c", None), ("d", [None, "ns1.x.com"])]
    got = names.normalize_list(spark.createDataFrame(rows, "domain string, ns array<string>"), "ns", Suffixes.of(spark, ["com", "org"]), ["domain"])
    assert {r["domain"]: r["ns_domains"] for r in got.collect()} == {"a": ["x.com", "y.org"], "b": [], "c": [], "d": ["x.com"]}
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_row_of_a_rank_reads_its_rows_once(spark):
    made, seen = _counted(spark)
    df = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("v"), F.col("id").alias("k")).where(seen("id"))
    row = ranks.row_at(df, [("v", True), ("k", True)], 2_500, small=20, sample=200)
    assert made.value == 3_000
    assert tuple(row) == (None, 3 * 499)
    assert ranks.row_at(df, [("v", True), ("k", True)], 3_001) is None


def test_zone_records_are_read_once_for_both_imports(spark, monkeypatch, tmp_path):
    made, seen = _counted(spark)
    sf = str(tmp_path)
    spark.createDataFrame([(i, i % 9, "FOP"[i % 3]) for i in range(30)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string").write.parquet(f"{sf}/orders.parquet")
    lines = [(i % 30, i % 7, i % 4, "ANA"[i % 3], "F") for i in range(120)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{sf}/lineitem.parquet")
    whole = catalog_updates.zone_records
    monkeypatch.setattr(catalog_updates, "zone_records", lambda *a: whole(*a).where(seen("ns")))
    for name in ("interned_lists", "diff_interned_snapshots"):
        made.value = 0
        assert catalog_layouts.QUERIES[name](spark, sf).count() > 0
        assert made.value == whole(spark, sf).count()


def test_addresses_on_many_names_are_spread_and_others_are_not(spark):
    rows = [(f"d{i}", ["10.0.0.1", f"10.0.{i}.9"] if i % 4 else ["10.0.0.1", None, "11.0.0.1"]) for i in range(40)]
    df = spark.createDataFrame(rows, "domain string, addr array<string>")
    nets = spark.createDataFrame([("10.0.0.0", 8, "AA"), ("10.0.7.0", 24, "BB")], "network string, prefix_len int, code string")
    want = {f"d{i}": ["AA", "BB"] if i == 7 else ["AA"] for i in range(40)}
    for hot in (0, 5, 1_000):
        got = enrich.lookup_lists(df, ["domain"], {"geo": (nets, "code")}, hot=hot)
        assert {r["domain"]: r["geo"] for r in got.collect()} == want


def test_a_batch_is_split_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(streams, "BATCH_ROWS", 100)
    packed = spark.range(1_001).coalesce(1)
    spread = streams._spread(packed)
    assert spread.rdd.getNumPartitions() == 11
    assert sorted(r["id"] for r in spread.collect()) == list(range(1_001))
    assert streams._spread(spark.range(50).coalesce(1)).rdd.getNumPartitions() == 1


def test_decoded_rows_do_not_carry_the_rules(spark):
    sent = spark.range(4).select(F.col("id").alias("seq"), F.format_string("a%d.com", "id").alias("key"), F.format_string('{"type":"Bad%d"}', "id").alias("value"),
                                 F.timestamp_seconds("id").alias("arrived"))
    for frame in merge.decode_updates(sent):
        todo = [frame._jdf.queryExecution().optimizedPlan()]
        while todo:
            node = todo.pop()
            assert "required:" not in node.schema().simpleString()
            todo += [node.children().apply(i) for i in range(node.children().size())]


def _sent(spark, docs):
    rows = [(i, "a.com", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "seq bigint, key string, value string").withColumn("arrived", F.timestamp_seconds(F.lit(0)))


def test_rules_of_messages_are_compiled(spark):
    """Reasons as before, from expressions that call no function per rule (functions of arrays are interpreted)."""
    pi = dict(type="PIResult", visits_12m=1, hits_12m=2, visits_arr_12m=[1], last_visit_date="2024-01-01", hits_geo="A", pi_rank=3)
    nx = dict(type="RDAPNXResult", registered=False)
    docs = {"": pi, "missing pi_rank": {k: v for k, v in pi.items() if k != "pi_rank"}, "null hits_geo; bad pi_rank": {**pi, "hits_geo": None, "pi_rank": "x"},
            "bad visits_arr_12m; bad last_visit_date": {**pi, "visits_arr_12m": 1, "last_visit_date": "2024"}, "null registered": {**nx, "registered": None},
            "bad registered; bad rdap_scraped": {**nx, "registered": "perhaps", "rdap_scraped": "soon"}, "bad pi_import_date": {**pi, "pi_import_date": "soon"},
            "not a JSON object": "[{}]", "unknown type": {}}
    bad = merge.decode_updates(_sent(spark, docs.values()))[1]
    assert {r["seq"]: r["reason"] for r in bad.collect()} == {i: r for i, r in enumerate(docs) if r}
    assert "lambda" not in bad._jdf.queryExecution().optimizedPlan().toString()
    rdap = [f for f in schema.UPDATE_TYPES["RDAPResult"].fields if f.required]
    got = merge.decode_updates(_sent(spark, [{"type": "RDAPResult", **{f.key: None for f in rdap}}, {"type": "RDAPResult"}]))[1].orderBy("seq").collect()
    assert got[0]["reason"] == "; ".join(f"null {f.key}" for f in rdap if not f.nullable)  # a member that is there may be NULL
    assert got[1]["reason"] == "; ".join(f"missing {f.key}" for f in rdap)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        merge.decode_updates(_sent(spark, ['{"type":"RDAPNXResult","registered":false,"registered":true}']))[0].collect()


def test_values_made_once_stand_below_the_generator(spark):
    df = once(spark.range(3), _a=F.col("id") * 2, _b=F.transform(F.array("id"), lambda x: x + 1))
    assert [(r["id"], r["_a"], r["_b"]) for r in df.where("_a > 0").orderBy("id").collect()] == [(1, 2, [2]), (2, 4, [3])]
    plan = df.where("_a > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline(array(_once" in plan and plan.count("* 2") == 1


def test_whole_updates_are_encoded_as_those_in_parts(spark):
    """One JSON expression per update where it carries its whole type; the text is that of column by column."""
    docs = [dict(type="RDAPNXResult", registered=False), dict(type="OwnershipResult", pm_username=None, pm_blacklisted=None),
            dict(type="DNSResult", addr=["1.2.3.4"], ns=['n"s'], txt=[], mx=[], dns_exists=True, rcode="NOERROR", ns_domains=[])]
    ups = merge.decode_updates(_sent(spark, docs))[0]
    whole = merge.encode_updates(ups)
    parts = merge.encode_updates(ups.withColumn("fields", F.reverse("fields")))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    assert '"pm_username":null' in "".join(r["value"] for r in whole.collect())


def test_wide_fold_runs_in_methods_that_are_compiled(spark, monkeypatch):
    key, inner, seen = "spark.sql.codegen.hugeMethodLimit", skew.in_blocks, []
    before = spark.conf.get(key)
    monkeypatch.setattr(skew, "in_blocks", lambda *a, **k: (seen.append(int(spark.conf.get(key))), inner(*a, **k))[1])
    ups = merge.decode_updates(_sent(spark, [dict(type="RDAPNXResult", registered=False)]))[0]
    rows, _ = merge.apply_updates(ups.select(*schema.TABLE_COLS).limit(0), ups, Suffixes.of(spark, ["com"]))
    assert seen == [8000] and spark.conf.get(key) == before and rows.count() == 1


def test_known_lines_are_the_label_lines_of_our_fields(spark):
    own = {label: name for name, labels in extract_whois.LABELS.items() for label in labels}
    texts = ["Status: a\r\n  Registrar :x\nStatus Reason: y\u2028\xa0Tech Email:\u3000 e:f \x0bAdmin Name: \t\nstatus: low\nStatus:\x85Domain Status:ok", "", ":", None,
             "".join(f"{s}{label}:{s}v{i}{s}{e}" for i, (label, s, e) in enumerate(zip(own, text.SPACE * 2, text.LINE_ENDS * 9)))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(extract_whois.label_lines(F.col("t")).alias("all"), extract_whois.known_lines(F.col("t")).alias("known"))
    for r in df.collect():
        want = None if r["all"] is None else [(own[x["label"]], x["value"]) for x in reversed(r["all"]) if x["label"] in own]
        assert (r["known"] and [tuple(x) for x in r["known"]]) == want
    assert df._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") < 8
