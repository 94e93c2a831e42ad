"""Heavy-hitter summaries, day sketches, trigram index and the zone data source on small frames."""

import gzip
import random
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_layouts import scanned_rows
from zonewright.operators import heavy, search, sketches, trigrams
from zonewright.sources import zone, zone_source


# --- heavy hitters -----------------------------------------------------------------------------------
def test_reduced_counters_err_by_what_was_taken_off():
    rng = random.Random(1)
    for _ in range(200):
        counts = np.array([rng.randrange(1, 12) for _ in range(rng.randrange(1, 40))])
        values = pa.array([f"v{i}" for i in range(len(counts))])
        capacity = rng.randrange(1, 30)
        left, kept, off = heavy.reduced(values, counts, capacity)
        assert len(kept) <= capacity and all(k > 0 for k in kept)
        held = dict(zip(left.to_pylist(), kept.tolist()))
        assert all(c - off <= held.get(f"v{i}", 0) <= c for i, c in enumerate(counts.tolist()))


def _values(spark, seed, frequent, n=20_000):
    rng = random.Random(seed)
    rows = [rng.choice(["aa", "bb", "cc", "dd"]) if rng.random() < frequent else rng.choice([None, "", f"r{rng.randrange(9000)}"]) for _ in range(n)]
    return rows, spark.createDataFrame([(v,) for v in rows], "v string").repartition(6)


@pytest.mark.parametrize("frequent, capacity, sure", [(0.5, 200, True), (0.5, 100_000, True), (0.0, 50, False)])
def test_most_frequent_with_and_without_certificate(spark, frequent, capacity, sure):
    rows, df = _values(spark, 3, frequent)
    top, certified = heavy.most_frequent(df, 4, capacity)
    counts = Counter(v for v in rows if v is not None)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]
    assert [tuple(r) for r in top.collect()] == want and certified == sure


def test_bounds_hold_and_summaries_merge(spark):
    rows, df = _values(spark, 5, 0.3)
    counts = Counter(v for v in rows if v is not None)
    parts = [heavy.summaries(df.where(c), 60) for c in ("length(v) = 2", "length(v) <> 2")]
    low, error = heavy.merged(parts[0].unionByName(parts[1]))
    assert error > 0 and all(r["low"] <= counts[r["v"]] <= r["low"] + error for r in low.collect())
    assert heavy.merged(heavy.summaries(df.limit(0)))[1] == 0


def test_facet_by_summaries_equals_facet(spark):
    df = spark.createDataFrame([(["ns1.a.net", "ns2.b.net", None], "x"), (["ns1.a.net"], ""), ([], None), (None, "x")], "ns array<string>, tld string")
    for col, criteria in (("ns", ()), ("tld", ()), ("ns", [("ns_domains", "exact", "a.net")])):
        assert heavy.facet(df, col, criteria, 3, capacity=1).collect() == search.facet(df, col, criteria, 3).collect()


# --- sketches ----------------------------------------------------------------------------------------
def test_names_of_spans_from_daily_sketches(spark, tmp_path):
    rng = random.Random(4)
    t0 = datetime(2024, 1, 1)
    log = [(rng.choice([None, *[f"d{rng.randrange(300)}" for _ in range(9)]]), rng.choice([None, *[t0 + timedelta(hours=rng.randrange(24 * 20))] * 9])) for _ in range(2000)]
    df = spark.createDataFrame(log, "domain string, last_modified timestamp")
    for part in ("last_modified < '2024-01-09'", "last_modified >= '2024-01-08'"):  # one day is stored twice
        sketches.daily_sketches(df.where(part)).write.mode("append").parquet(str(tmp_path / "s"))
    daily = spark.read.parquet(str(tmp_path / "s"))
    spans = [(date(2024, 1, a), date(2024, 1, b)) for a, b in ((1, 1), (3, 9), (1, 20), (8, 8), (9, 3))] + [(date(2025, 1, 1), date(2025, 2, 1))]
    got = {(r["first"], r["last"]): r["names"] for r in sketches.names_in_spans(daily, spark.createDataFrame(spans, "first date, last date")).collect()}
    assert got == {(a, b): len({d for d, t in log if d and t and a <= t.date() <= b}) for a, b in spans}
    for a, b in spans[:3]:
        old = {d for d, t in log if d and t and t.date() < a}
        new = {d for d, t in log if d and t and a <= t.date() <= b} - old
        assert sketches.new_names(daily, str(a), str(b)).first()["names"] == len(new)


def test_sketches_of_many_names_are_near(spark):
    days = spark.range(200_000).select(F.concat(F.lit("n"), F.col("id") % 150_000).alias("domain"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
                                       .cast("timestamp").alias("last_modified"))
    spans = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 4))], "first date, last date")
    got = sketches.names_in_spans(sketches.daily_sketches(days), spans).first()["names"]
    assert abs(got - 150_000) < 150_000 * 4 / 2**7


# --- trigrams ----------------------------------------------------------------------------------------
HOSTS = ["ns1.example.com", "ns2.example.com", "ns1.über.de", "漢字漢.cn", "a.b", "aaa", "aaaa", "x", "", "100%_.net", "ns1.example.com"]


def test_indexed_search_selects_what_the_predicate_selects(spark, tmp_path):
    rng = random.Random(6)
    rows = [(f"d{i}", rng.choice([None, [], [None], *[[rng.choice(HOSTS) for _ in range(rng.randrange(4))] for _ in range(6)]])) for i in range(200)]
    df = spark.createDataFrame(rows, "domain string, ns array<string>")
    trigrams.write_index(df, "ns", str(tmp_path / "i"))
    for pattern in ("example", "ns1.", "über", "漢字漢", "aaa", "aaaa", "a", "", "%_.", "1.e", "zzz", "example.org", ".example.com"):
        got = sorted(r["key"] for r in trigrams.search_keys(spark, str(tmp_path / "i"), pattern).collect())
        assert got == sorted(r["domain"] for r in search.search(df, [("ns", "substring", pattern)]).collect()), pattern


def test_indexed_search_of_a_text_column_and_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", "com"), ("b", None), ("c", "com.au")], "domain string, tld string")
    trigrams.write_index(df, "tld", str(tmp_path / "t"))
    assert sorted(r["key"] for r in trigrams.search_keys(spark, str(tmp_path / "t"), "com").collect()) == ["a", "c"]
    trigrams.write_index(df.limit(0), "tld", str(tmp_path / "none"))
    assert trigrams.search_keys(spark, str(tmp_path / "none"), "com").count() == 0


def test_indexed_search_reads_its_own_trigrams(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trigrams, "GROUP_BYTES", 1 << 14)
    df = spark.range(20_000).select(F.col("id").cast("string").alias("domain"), F.md5(F.col("id").cast("string")).alias("tld"))
    path = str(tmp_path / "i")
    trigrams.write_index(df, "tld", path)
    total = spark.read.parquet(f"{path}/grams").count()
    pattern = df.where("id = 77").first()["tld"][4:14]
    assert [r["key"] for r in trigrams.search_keys(spark, path, pattern).collect()] == ["77"]
    assert scanned_rows(trigrams.candidates(spark, path, pattern), "gram") < total / 5


# --- zone files as a source ---------------------------------------------------------------------------
def _zone_file(folder, tld, day, lines):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"zone-{tld}-{day}.gz", "wt") as f:
        f.write("".join(x + "\n" for x in lines))


def test_zone_source_opens_only_the_files_asked_for(spark, tmp_path):
    own, folder = zone_source.register(spark), tmp_path / "z"
    _zone_file(folder, "com", "2024-03-01", ["a.com. 1 in ns ns1.x.net.", "b.com. 1 in ns ns2.x.net."])
    _zone_file(folder, "com", "2024-03-02", ["a.com. 1 in ns ns1.x.net."])
    _zone_file(folder, "co.uk", "2024-03-02", [])
    (folder / "zone-net-2024-03-02.gz").write_bytes(b"not to be read")
    (folder / "zone-com-2024-13-40.gz").write_bytes(b"no day")
    (folder / "notes.txt").write_text("no zone")

    def load(source="zonefiles", **options):
        return own.read.format(source).options(**options).load(str(folder))

    assert load(tlds="com, co.uk").count() == 3 and load(tlds="com", first="2024-03-02").count() == 1
    assert load(last="2024-03-01").where("value like 'b%'").count() == 1 and load(tlds="none").columns == ["tld", "date", "value"]
    frame = load(tlds="com")
    assert frame.where("date = '2024-03-02'").count() == 1 and frame.count() == 3  # a filter leaves the frame as it is
    with pytest.raises(Exception, match="(?i)gzip"):
        load().count()
    lines = frame.withColumnRenamed("tld", "_zone").withColumn("tld", F.col("_zone"))
    mine = zone.parse_zone_lines(lines, keep=["_zone", "date"])
    paths = [str(folder / f"zone-com-2024-03-0{i}.gz") for i in (1, 2)]
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, zone.read_zone(spark, paths).collect()))
    pushing = "zonefiles_filtered"
    assert load(pushing).where("tld = 'com' and date >= '2024-03-02'").count() == 1 and load(pushing).where("tld in ('com', 'co.uk')").count() == 3
    assert load(pushing).where("tld = 'com' and date < '2024-03-02' and value like 'b%'").count() == 1
    assert spark.conf.get(zone_source.PUSHDOWN) == "false"


def test_zone_stream_takes_each_file_once(spark, tmp_path):
    own, folder, out = zone_source.register(spark), tmp_path / "z", str(tmp_path / "out")
    _zone_file(folder, "com", "2024-03-01", ["one"])

    def run():
        stream = own.readStream.format("zonefiles").load(str(folder))
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination())
        return sorted((r["tld"], r["value"]) for r in spark.read.schema(zone_source.SCHEMA).parquet(out).collect())

    assert run() == [("com", "one")]
    _zone_file(folder, "net", "2024-02-01", ["two", "three"])  # an earlier day, but a later file
    assert run() == [("com", "one"), ("net", "three"), ("net", "two")] == run()
