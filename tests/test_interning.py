"""The dictionary of lists on small frames, with hashes that collide and lists of every odd kind."""

import pytest
from pyspark.sql import functions as F

from test_layouts import SNAP, _snapshot_pair
from zonewright.operators import interning, snapshots


def rows(df):
    return sorted((repr(tuple(r)) for r in df.select("domain", "ns").collect()))


@pytest.mark.parametrize("seed, edits, kinds", [(1, 25, None), (2, 60, 3), (3, 0, 1)])
def test_diff_by_ids_equals_the_diff_of_lists(spark, tmp_path, monkeypatch, seed, edits, kinds):
    if kinds:  # few hashes: nearly all lists share theirs
        plain = interning.list_hash
        monkeypatch.setattr(interning, "list_hash", lambda v: F.pmod(plain(v), F.lit(kinds)))
    frames = [spark.createDataFrame(list(x.items()), SNAP).repartition(3) for x in _snapshot_pair(seed, edits=edits)]
    lists = interning.ListDictionary(spark, str(tmp_path))
    coded = []
    for f in frames:
        assert lists.add(f) == len(coded)
        coded.append(lists.encode(f))
        coded[-1].write.parquet(str(tmp_path / f"s{len(coded)}"))
    stored = [spark.read.parquet(str(tmp_path / f"s{i}")) for i in (1, 2)]
    assert rows(interning.diff_encoded(*stored, lists)) == rows(snapshots.diff_snapshots(*frames))
    # the first snapshot's ids still stand after the second import
    for f, s in zip(frames, stored):
        assert rows(lists.decode(s)) == rows(f)
    known = [tuple(r) for r in lists.lists().select("hash", "no", F.to_json(F.struct("ns"))).collect()]
    distinct = {repr(x) for f in frames for (x,) in f.select("ns").collect() if x is not None}
    assert len(known) == len({k[:2] for k in known}) == len({k[2] for k in known}) == len(distinct)


def test_lists_known_are_not_stored_again(spark, tmp_path):
    lists = interning.ListDictionary(spark, str(tmp_path))
    assert lists.lists().isEmpty() and lists.versions() == 0
    snap = spark.createDataFrame([(f"d{i}.com", ["a", "b"]) for i in range(500)] + [("x.com", None), ("y.com", [])], SNAP)
    lists.add(snap)
    lists.add(snap)
    lists.add(snap.limit(0))
    assert lists.lists().count() == 2 and lists.versions() == 3
    # an import that stopped half-way is made again under the same number
    snap.where("domain = 'y.com'").select(F.lit(1).alias("hash"), F.lit(0).alias("no"), "ns").write.parquet(f"{tmp_path}/lists/version=3")
    assert lists.lists().count() == 2 and lists.add(spark.createDataFrame([("z.com", ["c"])], SNAP)) == 3 and lists.lists().count() == 3


def test_encoding_moves_no_rows(spark, tmp_path):
    lists = interning.ListDictionary(spark, str(tmp_path))
    snap = spark.createDataFrame([(f"d{i}.com", ["a", str(i % 7)]) for i in range(100)], SNAP)
    lists.add(snap)
    plan = lists.encode(snap)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
