"""Keyed state, bucketed and indexed tables, address ranges, fingerprints, ranks and validity on small frames."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_streams import NOW, _msgs, _nx, _zone
from zonewright import schema
from zonewright.operators import enrich, fingerprints, history, intervals, merge, ranks, search, selection, snapshots
from zonewright.operators.names import Suffixes
from zonewright.sources import keyed_tables, messages
from zonewright.streaming import keyed, streams
from zonewright.streaming.store import VersionStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df, column):
    """Rows that the Parquet scan with `column` gave out while df ran."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")  # a plan of its own, made without adaptive execution
        again.collect()
        total, todo = 0, [again._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("Scan parquet") and column in node.toString():
                total += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- keyed state ---------------------------------------------------------------------------------
def _dns(domain, ok):
    return {"type": "DNSResult", "domain": domain, "addr": ["1.2.3.4"], "ns": ["NS1.x"], "txt": [], "mx": [], "dns_exists": ok, "rcode": "NOERROR",
            "ns_domains": ["x"], "modified_by": "dns"}


def _random_docs(seed, n):
    rnd = random.Random(seed)
    makers = [lambda d: _zone(d, [f"ns{rnd.randrange(4)}.x"]), _nx, lambda d: _dns(d, rnd.random() < 0.5), lambda d: {"type": "Bad", "domain": d},
              lambda d: {"type": "WHOISNXResult", "domain": d, "registered": True}]
    names = ["a.com", "b.com", "c.us", "odd.zz", "plain", "d.com"]
    return [rnd.choice(makers)(rnd.choice(names)) for _ in range(n)]


def test_keyed_state_gives_what_the_batch_merge_gives_over_a_restart(spark, tmp_path):
    own = keyed.state_session(spark)
    s, docs = Suffixes.of(own, ["com", "us"]), _random_docs(4, 45)
    cuts = [docs[:20], docs[20:21], docs[21:]]
    batch = VersionStore(spark, str(tmp_path / "batch"), buckets=2, order=("batch_id", "seq"))
    state = VersionStore(own, str(tmp_path / "state"))
    src, at = str(tmp_path / "in"), 0
    for n, part in enumerate(cuts):
        frame = _msgs(spark, part, at)
        streams.upsert_batch(batch, messages.result_messages(frame), n, s)
        frame.write.mode("append").parquet(src)
        at += len(part)
        for running in keyed.stream_versions(messages.read_stream(own, "parquet", {}, src), state, str(tmp_path / "ck"), s, trigger=NOW):
            running.awaitTermination()

    def rows(df):
        return sorted(map(str, df.select("seq", "domain", "tld", "ns", "registered", "dns_exists", "modified_by", "last_modified", "batch_id").collect()))

    assert rows(state.log()) == rows(batch.log()) and len(rows(state.log())) > 20
    held = keyed.current_rows(own, str(tmp_path / "ck")).drop("seq")
    want = batch.current().select(held.columns)
    assert sorted(map(str, held.collect())) == sorted(map(str, want.collect()))
    for mine, theirs in (("refused", "unknown suffix"), ("quarantine", "unknown type")):
        got = sorted(r["seq"] for r in spark.read.parquet(f"{state.root}/{mine}").collect())
        assert got == sorted(r["seq"] for r in spark.read.parquet(f"{batch.root}/quarantine").where(F.col("reason").startswith(theirs)).collect()) and got
    requests = [sorted(map(str, spark.read.parquet(f"{x.root}/requests").select("topic", "key").collect())) for x in (state, batch)]
    assert requests[0] == requests[1]


def test_keyed_state_needs_its_session(spark):
    stream = spark.readStream.format("rate").load().selectExpr("cast(value as string) domain", "value seq", "array('registered') fields")
    with pytest.raises(ValueError, match="state_session"):
        keyed.versions_of(stream, Suffixes.of(spark, ["com"]))
    assert spark.conf.get(keyed.PROVIDER, "") != keyed.ROCKSDB


def test_keyed_state_hands_python_few_cells_a_row(spark):
    own = keyed.state_session(spark)
    rows = own.readStream.format("rate").load().select(F.col("value").alias("seq"), F.array(F.lit("registered")).alias("fields"),
                                                       *[F.lit(None).cast(t).alias(c) for c, t in schema.TABLE_TYPES.items()])
    todo, widths = [keyed.versions_of(rows, Suffixes.of(own, ["com"]))._jdf.queryExecution().analyzed()], []
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("TransformWithState"):
            widths += [node.output().size(), *(node.children().apply(i).output().size() for i in range(node.children().size()))]
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert widths and max(widths) <= 6  # not one cell for each column of the table


def test_packed_rows_come_back_as_they_were(spark):
    odd = {"last_modified": datetime(1969, 12, 31, 23, 59, 59, 999999), "dns_scraped": datetime(2024, 3, 31, 2, 30, 0, 1), "zonefile_date": date(1, 1, 1), "pi_rank": 2**63 - 1,
           "hits_12m": -2**63, "txt": ["a,b", None, "", '"\\\n\u2028\U0001f600'], "visits_arr_12m": [], "registered": False, "whois_text": "\x00\t\u00e9", "tld": ""}
    kinds = schema.table_schema()
    frame = spark.createDataFrame([tuple(odd.get(c) for c in schema.TABLE_COLS), (None,) * len(schema.TABLE_COLS)], kinds)
    cols = [c for c in schema.TABLE_COLS if c != "domain"]
    back = keyed._unpacked(frame.select("domain", keyed._packed(cols).alias("packed")), cols, ["domain"]).select(frame.columns)
    assert back.dtypes == frame.dtypes
    assert back.collect() == frame.collect()


# --- tables by key ---------------------------------------------------------------------------------
def _named(spark, n):
    return spark.range(n).select(F.format_string("n%06d.com", F.pmod(F.xxhash64("id"), F.lit(1_000_000))).alias("domain"), F.col("id").alias("v"),
                                 F.lit("com").alias("tld")).dropDuplicates(["domain"])


def test_bucketed_table_is_not_moved_by_a_merge(spark, tmp_path):
    view = _named(spark, 4000)
    stored = keyed_tables.write_bucketed(view, "zw_bucketed", str(tmp_path / "t"), rows_per_bucket=500)
    try:
        assert stored.count() == view.count() and keyed_tables.buckets_for(view.count(), 500) == 8
        touched = _named(spark, 9000).select("domain")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined, grouped = stored.join(touched, "domain", "left_semi"), stored.groupBy("domain").agg(F.max("v"))
        plan = plan_of(joined)
        base = plan[: plan.index("zw_bucketed")].rsplit("SortMergeJoin", 1)[1]
        assert "Exchange" not in base and "Bucketed: true" in plan and "Exchange" not in plan_of(grouped)
        assert joined.count() == view.join(touched, "domain", "left_semi").count()
        with_updates = spark.createDataFrame([(1, "n000001.com", ["tld"], "net")], "seq bigint, domain string, fields array<string>, tld string")
        assert merge.merge_updates(stored.select("domain", "tld"), with_updates, ["tld"]).count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        keyed_tables.drop_table(spark, "zw_bucketed")


@pytest.mark.parametrize("rows, buckets", [(0, 1), (1, 1), (4_000_000, 1), (4_000_001, 2), (9_000_000, 4), (10**12, 1 << 18)])
def test_bucket_count_follows_the_rows(rows, buckets):
    assert keyed_tables.buckets_for(rows) == buckets


def test_lookup_of_names_reads_little_of_a_sorted_table(spark, tmp_path):
    view = _named(spark, 100_000)
    path = str(tmp_path / "names")
    stored = keyed_tables.write_lookup(view, path, files=8, group_bytes=1 << 16, page_rows=100)
    total = stored.count()
    there = [r["domain"] for r in view.orderBy("v").limit(100).collect()]
    asked = there[:100] + ["no.such.name", "n0000.com"]
    found = keyed_tables.lookup(stored, asked)
    assert sorted(r["domain"] for r in found.collect()) == sorted(there)
    assert scanned_rows(found, "domain") < total / 3
    one = keyed_tables.lookup(stored, there[:1])
    assert one.count() == 1 and scanned_rows(one, "domain") < total / 100
    assert scanned_rows(keyed_tables.lookup(stored, ["n5000000.com"]), "domain") <= 1000


def test_bloom_filter_skips_groups_whose_bounds_hold_the_name(spark, tmp_path):
    # every file spans all names, as the files of a log do
    path, view = str(tmp_path / "log"), _named(spark, 50_000)
    options = {"parquet.bloom.filter.enabled#domain": "true", "parquet.bloom.filter.expected.ndv#domain": "50000", "parquet.enable.dictionary": "false"}
    view.repartition(8, "v").write.options(**options).parquet(path)
    read = spark.read.schema(view.schema).parquet(path)
    absent = keyed_tables.lookup(read, ["n500000x.com"])
    assert absent.count() == 0 and scanned_rows(absent, "domain") == 0


def test_lookup_by_list_frame_or_join_is_the_same(spark, tmp_path):
    view = _named(spark, 500)
    names = view.where("v % 7 = 0").select("domain").unionByName(spark.createDataFrame([(None,), ("x",), ("x",)], "domain string"))
    want = sorted(r["domain"] for r in view.where("v % 7 = 0").collect())
    for got in (keyed_tables.lookup(view, names), keyed_tables.lookup(view, names, pushed=3), keyed_tables.lookup(view, [r["domain"] for r in names.collect()])):
        assert sorted(r["domain"] for r in got.collect()) == want
    assert keyed_tables.lookup(view, []).count() == 0


# --- address ranges ----------------------------------------------------------------------------------
def _address(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def _random_networks(seed, n, least=0):
    rnd = random.Random(seed)
    spots = [rnd.randrange(1 << 32) for _ in range(6)]
    out = []
    for _ in range(n):
        near = rnd.choice(spots) ^ rnd.randrange(1 << rnd.choice([4, 10, 20, 32]))
        out.append((_address(near), rnd.randint(least, 32), rnd.choice([None, *"ABCDEFG"])))
    return out, spots


def _innermost(address, networks):
    parts = address.split(".")
    if len(parts) != 4 or not all(p.isdigit() and int(p) < 256 for p in parts):
        return None
    n = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0)))
    best = max(((b, v) for a, b, v in networks if v is not None
                and n >> (32 - b) == sum(int(p) << s for p, s in zip(a.split("."), (24, 16, 8, 0))) >> (32 - b)), default=None)
    return best and best[1]


@pytest.mark.parametrize("seed, least", [(1, 0), (2, 8), (3, 24)])
def test_range_lookup_equals_longest_prefix_and_brute_force(spark, seed, least):
    rnd = random.Random(seed)
    (geo, spots), (asn, _) = _random_networks(seed, 200, least), _random_networks(seed + 9, 30, least)
    ips = {_address(rnd.choice(spots) ^ rnd.randrange(1 << rnd.choice([3, 9, 19, 32]))) for _ in range(300)}
    ips |= {"0.0.0.0", "255.255.255.255", "1.2.3", "x", *(a for a, _, _ in geo[:40])}
    frame = spark.createDataFrame([(x,) for x in ips] + [(None,)], "addr string")
    ddl = "network string, prefix_len int, value string"
    tables = {"geo": (spark.createDataFrame(geo, ddl), "value"), "asn": (spark.createDataFrame(asn, ddl), "value")}
    got = {r["addr"]: (r["geo"], r["asn"]) for r in intervals.range_lookup(frame, tables, blocks=5).collect()}
    brute = {x: (_innermost(x, geo), _innermost(x, asn)) for x in ips}
    assert got == {x: v for x, v in brute.items() if any(v)}
    plain = {r["addr"]: (r["geo"], r["asn"]) for r in enrich.longest_prefix(frame.dropna(), tables).collect()}
    assert got == {x: v for x, v in plain.items() if any(v)}


def test_flattened_ranges_do_not_overlap_and_cover_all_networks(spark):
    networks, _ = _random_networks(5, 300)
    table = spark.createDataFrame(networks + networks[:20], "network string, prefix_len int, value string")
    nested = intervals.network_ranges(table, "value")
    flat = sorted(map(tuple, intervals.flattened(nested).collect()))
    assert all(a[1] < b[0] for a, b in zip(flat, flat[1:])) and all(s <= e for s, e, _ in flat)
    edges = sorted({p for r in nested.collect() for p in (r["start"], r["end"] + 1)})
    covered = sum(b - a for a, b in zip(edges, edges[1:]) if any(v is not None and int(_n(x)) >> (32 - n) == a >> (32 - n) for x, n, v in networks))
    assert covered == sum(e - s + 1 for s, e, _ in flat)


def _n(address):
    return sum(int(p) << s for p, s in zip(address.split("."), (24, 16, 8, 0)))


def test_sweep_holds_open_ranges_only():
    assert list(intervals.sweep([(0, 99, "a"), (10, 49, "b"), (10, 19, "c"), (30, 30, "d"), (200, 210, "e")])) == [
        (0, 9, "a"), (10, 19, "c"), (20, 29, "b"), (30, 30, "d"), (31, 49, "b"), (50, 99, "a"), (200, 210, "e")]
    assert list(intervals.sweep([])) == []


# --- fingerprints ------------------------------------------------------------------------------------
SNAP = "domain string, ns array<string>"


def _snapshot_pair(seed, n=400, edits=25):
    rnd = random.Random(seed)
    lists = [None, [], [None], [None, "a"], ["a", None], ["a"], ["a", "a"], ["a", "b"], ["b"]]
    prev = {f"d{i}.com": rnd.choice(lists) for i in range(n)}
    cur = dict(prev)
    for d in rnd.sample(sorted(cur), edits):
        if rnd.random() < 0.3:
            del cur[d]
        else:
            cur[d] = rnd.choice(lists)
    cur.update({f"new{i}.com": rnd.choice(lists) for i in range(edits // 3)})
    return prev, cur


@pytest.mark.parametrize("seed, levels, edits", [(1, 1, 25), (3, 3, 3), (4, 2, 0)])
def test_stored_diff_equals_full_diff(spark, tmp_path, seed, levels, edits):
    frames = [spark.createDataFrame(list(x.items()), SNAP) for x in _snapshot_pair(seed, edits=edits)]
    for name, f in zip(("p", "c"), frames):
        fingerprints.write_snapshot(f, str(tmp_path / name), levels=levels)
    got = sorted(map(str, fingerprints.diff_stored(spark, str(tmp_path / "p"), str(tmp_path / "c")).collect()))
    assert got == sorted(map(str, snapshots.diff_snapshots(*frames).collect())) and bool(got) == bool(edits)


def test_stored_diff_reads_changed_folders_only(spark, tmp_path):
    prev, cur = _snapshot_pair(7, 600, 0)
    cur["d5.com"] = ["moved"]
    for name, rows in (("p", prev), ("c", cur)):
        fingerprints.write_snapshot(spark.createDataFrame(list(rows.items()), SNAP), str(tmp_path / name))
    nodes = [r[0] for r in fingerprints.changed_nodes(spark, str(tmp_path / "p"), str(tmp_path / "c")).collect()]
    assert len(nodes) == 1
    spoilt = 0
    for file in tmp_path.glob("*/rows/_folder=*/*.parquet"):
        if file.parent.name != f"_folder={nodes[0] >> 8}":
            file.write_bytes(b"not to be read")
            spoilt += 1
    assert [tuple(r) for r in fingerprints.diff_stored(spark, str(tmp_path / "p"), str(tmp_path / "c")).collect()] == [("d5.com", ["moved"])]
    assert spoilt > 300


def test_stored_diff_of_empty_snapshots_and_unlike_trees(spark, tmp_path):
    none, some = spark.createDataFrame([], SNAP), spark.createDataFrame([("a", ["x"]), ("b", None)], SNAP)
    for name, f, levels in (("none", none, 2), ("some", some, 2), ("deep", some, 3)):
        fingerprints.write_snapshot(f, str(tmp_path / name), levels=levels)
    at = lambda x: str(tmp_path / x)
    assert fingerprints.diff_stored(spark, at("none"), at("none")).count() == 0
    assert sorted(map(tuple, fingerprints.diff_stored(spark, at("none"), at("some")).collect())) == [("a", ["x"]), ("b", None)]
    assert sorted(map(tuple, fingerprints.diff_stored(spark, at("some"), at("none")).collect())) == [("a", []), ("b", [])]
    with pytest.raises(ValueError, match="unlike depth"):
        fingerprints.diff_stored(spark, at("some"), at("deep"))
    with pytest.raises(ValueError):
        fingerprints.write_snapshot(some, at("x"), levels=5)


# --- ranks -----------------------------------------------------------------------------------------
def _ranked_rows(spark, n=3000):
    rnd = random.Random(8)
    t0 = datetime(2024, 1, 1)
    rows = [(f"k{i:05d}", rnd.choice([None, 1, 1, 1, rnd.randrange(9)]), None if rnd.random() < 0.5 else t0 + timedelta(seconds=rnd.randrange(40)),
             rnd.choice(["", "é", "漢", "a" * 30, "a" * 30 + "b", None])) for i in range(n)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "domain string, visits_12m int, last_modified timestamp, tld string")


def _python_order(rows, order):
    out = sorted(rows, key=lambda r: r[0].encode())
    place = {"domain": 0, "visits_12m": 1, "last_modified": 2, "tld": 3}
    for col, up in reversed(order):
        value = lambda r, c=place[col]: r[c].encode() if isinstance(r[c], str) else r[c]
        out = sorted([r for r in out if r[place[col]] is not None], key=value, reverse=not up) + [r for r in out if r[place[col]] is None]
    return [r[0] for r in out]


@pytest.mark.parametrize("order", [[("domain", True)], [("domain", False)], [("visits_12m", True), ("domain", True)], [("visits_12m", False), ("domain", True)],
                                   [("last_modified", False), ("tld", True), ("domain", False)]])
def test_ranks_equal_a_full_sort(spark, monkeypatch, order):
    rows, df = _ranked_rows(spark)
    # sorting by the last key first, then stably by those before it
    want = _python_order(rows, order)
    df = df.cache()
    for n in (1, 777, 3000):
        cut = ranks.row_at(df, order, n, small=40, sample=64)
        assert cut is not None
        head = ranks.first_rows(df, order, n, small=100)
        assert sorted(r["domain"] for r in head.collect()) == sorted(want[:n])
    assert ranks.row_at(df, order, 0) is None and ranks.row_at(df, order, 3001) is None
    for offset, limit in ((0, 5), (1400, 30), (2995, 30)):
        assert [r["domain"] for r in ranks.rows_between(df, order, offset, limit, small=100).collect()] == want[offset : offset + limit]
    df.unpersist()


def test_rank_among_rows_that_are_all_alike(spark):
    df = spark.range(500).select(F.lit("x").alias("a"))
    assert tuple(ranks.row_at(df, [("a", True)], 250, small=10, sample=16)) == ("x",)


def test_deep_page_and_selection_plan_no_task_that_holds_what_is_before(spark):
    _, df = _ranked_rows(spark)
    page = search.Page("visits_12m", "desc", 20, 1000)
    assert [tuple(r) for r in search.deep_page(df, page, small=100).collect()] == [tuple(r) for r in search.page(df, page).collect()]
    assert "Limit" not in plan_of(selection.shuffled(df, 1200)) and selection.shuffled(df, 1200).count() == 1200
    assert selection.shuffled(df, 0).count() == 0 and selection.shuffled(df, 9999).count() == 3000
    for n in (0, 5, 3000, 4000):
        named = df.unionByName(df.limit(3).withColumn("domain", F.lit(None).cast("string")))
        assert search.first_by_key(named, n, small=50).count() == min(n, 3003)


# --- validity ----------------------------------------------------------------------------------------
def test_as_of_day_equals_replaying_the_log(spark, tmp_path):
    rnd = random.Random(2)
    t0 = datetime(2024, 1, 1)
    log = [(i, f"d{rnd.randrange(12)}", rnd.choice([None, *[t0 + timedelta(hours=rnd.randrange(24 * 80))] * 9]), rnd.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(log + [(300, "d1", log[0][2], 9)], "seq bigint, domain string, last_modified timestamp, visits_12m bigint")
    history.write_validity(history.validity(df, blocks=7), str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    for day in (1, 17, 31, 45, 60, 90):
        end = t0 + timedelta(days=day)
        name = (end - timedelta(days=1)).strftime("%Y-%m-%d")
        newest = {}
        for seq, d, at, v in sorted(log + [(300, "d1", log[0][2], 9)], key=lambda r: (r[2] is not None, r[2] or t0, r[0])):
            if at is None or at < end:
                newest[d] = (seq, v)
        got = {r["domain"]: (r["seq"], r["visits_12m"]) for r in history.as_of_day(stored, name).collect()}
        assert got == newest
    assert re.search(r"PartitionFilters: \[.*ended", plan_of(history.as_of_day(stored, "2024-03-01")))


def test_tags_by_id_and_by_search(spark):
    tags = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, None, "c")], "id bigint, search_id bigint, name string")
    assert [r["name"] for r in search.tag_by_id(tags, 2).collect()] == ["b"] and search.tag_by_id(tags, 9).count() == 0
    assert [r["name"] for r in search.tag_of_search(tags, 7).collect()] == ["a"] and search.tag_of_search(tags, 8).count() == 0
