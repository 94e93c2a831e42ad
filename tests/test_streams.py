"""Streams over files: upsert, restart, repeated batches, bad records, follow-ups, compaction."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from zonewright import schema
from zonewright.operators.names import Suffixes
from zonewright.sources import messages
from zonewright.streaming import streams
from zonewright.streaming.store import VersionStore

NOW = {"availableNow": True}


def _msgs(spark, docs, start, topic="results"):
    rows = [(topic, d.get("domain", "x.com").upper(), json.dumps(d), start + i, datetime(2024, 1, 1, 0, 0, start + i)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, messages.MESSAGE).coalesce(1)


def _zone(domain, ns):
    return {"type": "ZonefileResult", "domain": domain, "ns": ns, "ns_domains": [], "tld": "com", "zonefile_date": "2024-01-01",
            "modified_by": "zonefile"}


def _nx(domain):
    return {"type": "RDAPNXResult", "domain": domain, "registered": False}


def test_stream_updates_restart_and_quarantine(spark, tmp_path):
    src, root, ckpt = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ck")
    s = Suffixes.of(spark, ["com", "us"])
    store = VersionStore(spark, root, buckets=2)

    def run():
        stream = messages.read_stream(spark, "parquet", {}, src)
        streams.stream_updates(stream, store, ckpt, s, trigger=NOW).awaitTermination()

    _msgs(spark, [_zone("a.com", ["ns1.x"]), _nx("a.com"), _zone("b.us", []), {"type": "Bad"}, _nx("c.zz")], 0).write.mode("append").parquet(src)
    run()
    assert store.log().count() == 3
    run()  # nothing new: nothing more
    assert store.log().count() == 3
    _msgs(spark, [_zone("a.com", ["ns2.x"])], 10).write.mode("append").parquet(src)
    run()
    cur = {r["domain"]: r for r in store.current().collect()}
    assert set(cur) == {"a.com", "b.us"} and cur["a.com"]["ns"] == ["ns2.x"] and cur["a.com"]["registered"] is False
    assert store.history().where("domain = 'a.com'").count() == 3
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert reasons == ["unknown suffix: c.zz", "unknown type"]
    req = sorted((r["key"], r["topic"]) for r in spark.read.parquet(f"{root}/requests").collect())
    assert req == [("a.com", "scrape.dns"), ("a.com", "scrape.dns"), ("a.com", "scrape.rdap"), ("a.com", "scrape.rdap"),
                   ("b.us", "scrape.dns"), ("b.us", "scrape.whois")]


def test_new_checkpoint_keeps_the_log_and_days_can_be_pruned(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "store")
    s, store = Suffixes.of(spark, ["com"]), VersionStore(spark, root, buckets=2)
    _msgs(spark, [_zone("a.com", ["1"]), _nx("b.com")], 0).write.parquet(src)
    for n in (1, 2):
        stream = messages.read_stream(spark, "parquet", {}, src)
        streams.stream_updates(stream, store, str(tmp_path / f"ck{n}"), s, compact_every=1, trigger=NOW).awaitTermination()
        assert store.log().count() == 2 * n and store.current().count() == 2
    assert [r["batch_id"] for r in store.log().select("batch_id").distinct().orderBy("batch_id").collect()] == [0, 1]
    day = store.history().where("date = '2024-01-01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 4 and "PartitionFilters: [isnotnull(date" in plan


def test_a_batch_reads_only_the_buckets_of_its_names(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "store"), buckets=8)
    docs = [_nx(f"n{i}.com") for i in range(60)]
    streams.upsert_batch(store, messages.result_messages(_msgs(spark, docs[:50], 0)), 0, Suffixes.of(spark, ["com"]))
    store.compact(0)
    touched = spark.createDataFrame([("n7.com",), (None,)], "domain string")
    seen = VersionStore(spark, store.root, buckets=3).current(touched=touched)  # the base says how it was split
    want = [r["domain"] for r in seen.collect()]
    files = {f.parent.name: f for f in (tmp_path / "store" / "base").glob("upto=0/bucket=*/*.parquet")}
    mine = touched.where("domain is not null").select(store._bucket(8)).first()[0]
    for name, file in files.items():
        if name != f"bucket={mine}":
            file.write_bytes(b"not to be read")
    again = VersionStore(spark, store.root, buckets=3).current(touched=touched)
    assert want == ["n7.com"] == [r["domain"] for r in again.collect()] and len(files) > 1


def test_repeated_batch_counts_once_and_compaction_keeps_the_view(spark, tmp_path):
    s = Suffixes.of(spark, ["com"])
    store = VersionStore(spark, str(tmp_path / "store"), buckets=2, order=("batch_id", "seq"))

    def batch(docs, n):
        streams.upsert_batch(store, messages.result_messages(_msgs(spark, docs, n * 10)), n, s)

    batch([_zone("a.com", ["1"]), _nx("b.com")], 0)
    batch([_nx("a.com")], 1)
    batch([_nx("a.com")], 1)  # the same batch again
    assert store.log().count() == 3

    def view():
        return sorted(map(str, store.current().collect()))

    before = view()
    store.compact(1)
    store.compact(1)
    assert view() == before
    batch([_zone("b.com", ["2"])], 2)
    cur = {r["domain"]: r for r in store.current().collect()}
    assert cur["b.com"]["ns"] == ["2"] and cur["b.com"]["registered"] is False and cur["a.com"]["ns"] == ["1"]
    store.compact(2)
    assert {r["domain"]: r["ns"] for r in store.current().collect()} == {"a.com": ["1"], "b.com": ["2"]}


def _stored(spark, path, numbers, **options):
    """A store with a batch per number: nN.com is new in each, all.com is written again."""
    store = VersionStore(spark, str(path), **{"buckets": 2, "order": ("batch_id", "seq"), **options})
    for n in numbers:
        store.append(_versions(spark, [(0, f"n{n}.com", []), (1, "all.com", [str(n)])]), n)
    return store


def _versions(spark, rows):
    given = spark.createDataFrame(rows, "seq bigint, domain string, ns array<string>").coalesce(1)
    at = F.lit("2024-01-01").cast(schema.TABLE_TYPES["last_modified"])
    rest = [F.lit(None).cast(t).alias(c) for c, t in schema.TABLE_TYPES.items() if c not in ("domain", "ns", "last_modified")]
    return given.select("*", at.alias("last_modified"), *rest)


def _view(store, **options):
    return sorted((r["domain"], str(r["ns"])) for r in store.current(**options).select("domain", "ns").collect())


def test_the_newest_batches_are_read_without_listing_old_spans(spark, tmp_path, monkeypatch):
    from zonewright.streaming import store as module
    monkeypatch.setattr(module, "SPAN", 2)
    store = _stored(spark, tmp_path / "s", range(5))
    assert sorted(p.name for p in (tmp_path / "s" / "log").glob("span=*")) == ["span=0", "span=1", "span=2"]
    want, as_of_two = _view(store), _view(store, before=2)
    assert as_of_two == [("all.com", "['1']"), ("n0.com", "[]"), ("n1.com", "[]")] and store.log().count() == 10
    store.compact(3)
    (tmp_path / "s" / "log" / "span=0" / "batch_id=none").mkdir()  # a listing of this folder would fail
    for old in (tmp_path / "s" / "log" / "span=1").glob("batch_id=*/*/*.parquet"):
        old.write_bytes(b"not to be read")
    assert _view(store) == want and len(want) == 6


def test_old_bases_go_and_older_views_stay(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "s"))
    assert store.drop_old_bases() == []
    store = _stored(spark, tmp_path / "s", range(4))
    views = [_view(store, before=n) for n in range(1, 5)]
    for n in range(3):
        store.compact(n)
    assert store.drop_old_bases(keep=2) == [0] and store.drop_old_bases(keep=2) == []
    assert sorted(store._numbers("base", "upto")) == [1, 2]
    assert [_view(store, before=n) for n in range(1, 5)] == views
    # noted, but not yet removed: read no more, removed by the next call
    spark.createDataFrame([(1,)], "upto bigint").write.mode("append").parquet(f"{store.root}/base_dropped")
    assert [_view(store, before=n) for n in range(1, 5)] == views
    assert store.drop_old_bases(keep=1) == [] and store._numbers("base", "upto") == [2]


def test_buckets_follow_the_rows_and_are_sorted(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "s"), buckets=2, bucket_rows=10)
    store.append(_versions(spark, [(i, f"n{i:02}.com", []) for i in range(55)]), 0)
    store.compact(0)
    assert store._base(None)[1:] == (0, 6) and store.current().count() == 55
    for file in (tmp_path / "s" / "base").glob("upto=0/bucket=*/*.parquet"):
        names = [r["domain"] for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert names == sorted(names) and names
    store.bucket_rows = 1  # made again: as many as before
    store.compact(0)
    assert store._base(None)[1:] == (0, 6) and store.current().count() == 55


def test_stream_errors(spark, tmp_path):
    doc = {"error": "e", "error_type": "T", "file": "f", "line": 3, "traceback": "", "scraper": "dns", "topic": "t", "timestamp": "2024-01-02T03:04:05"}
    src, out, ck, bad = (str(tmp_path / n) for n in ("in", "out", "ck", "bad"))
    for i in range(2):
        _msgs(spark, [doc, {**doc, "timestamp": "soon"}, doc], i * 10, "errors").write.mode("append").parquet(src)
        for running in streams.stream_errors(messages.read_stream(spark, "parquet", {}, src), out, ck, bad, NOW):
            running.awaitTermination()
    assert [r["reason"] for r in spark.read.parquet(bad).collect()] == ["not an error message"] * 2
    rows = spark.read.parquet(out)
    assert rows.count() == 4 and rows.select("uuid").distinct().count() == 4
    assert [str(r["day"]) for r in rows.select("day").distinct().collect()] == ["2024-01-02"]


def test_stream_rate_equals_batch_rate(spark, tmp_path):
    from zonewright.operators.reports import request_rate
    rows = [("x" if i % 3 else "y", datetime(2024, 1, 1, 0, 0, i // 4)) for i in range(40)] + [("x", datetime(2024, 1, 1, 1, 0, 0))]
    df = spark.createDataFrame(rows, "target string, ts timestamp")
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    df.where("ts < '2024-01-01 00:30:00'").coalesce(1).write.parquet(src)
    df.where("ts >= '2024-01-01 00:30:00'").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    rate = streams.stream_request_rate(stream, "target", "ts", 2)
    q = rate.writeStream.outputMode("append").format("memory").queryName("rates").option("checkpointLocation", ck).trigger(**NOW).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.table("rates").collect()}
    want = {tuple(r) for r in request_rate(df, "target", "ts", 2).where(F.col("window_start") < "2024-01-01 00:30:00").collect()}
    assert got == want and want


def test_history_partitions(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2))], "domain string, last_modified timestamp")
    messages.append_history(df, str(tmp_path / "h"))
    back = spark.read.parquet(str(tmp_path / "h"))
    assert back.where("date = '2024-01-02'").count() == 1
    messages.write_messages(df.select(F.col("domain").alias("key"), F.lit("{}").alias("value")), "json", {}, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
