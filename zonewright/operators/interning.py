"""Nameserver lists kept once each, under ids that stay the same from snapshot to snapshot.

The id of a list is its hash and a number, which is 0 unless different lists share the hash. So the id of nearly every list
follows from the list alone: rows get theirs without meeting the dictionary, whose size does not matter then; only
lists whose hash another one has too are looked up, in a table of their own. Snapshots hold ids, and a difference of
two compares ids; lists are read for changed rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ENTRY = "hash bigint, no int, ns array<string>"


def list_hash(value: Column) -> Column:
    # as JSON: a missing list, an empty one and a missing element are all told apart
    return F.xxhash64(F.to_json(F.struct(value.alias("v"))))


class ListDictionary:
    """Lists of strings under `root`: `lists/version=n` holds what import n added, `shared/version=n` the lists whose hash is shared, as of then.

    One import at a time writes. A version counts once `shared` of it is complete, so an import that failed is simply made again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, part: str, version: int) -> str:
        return f"{self.root}/{part}/version={version}"

    def versions(self) -> int:
        """How many imports are complete."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        n = 0
        while True:
            done = jvm.org.apache.hadoop.fs.Path(f"{self._path('shared', n)}/_SUCCESS")
            if not done.getFileSystem(conf).exists(done):
                return n
            n += 1

    def lists(self) -> DataFrame:
        """(hash, no, ns) of every list known."""
        paths = [self._path("lists", v) for v in range(self.versions())]
        reader = self.spark.read.schema(_ENTRY)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], _ENTRY)

    def shared(self) -> DataFrame:
        n = self.versions()
        return self.spark.read.schema(_ENTRY).parquet(self._path("shared", n - 1)) if n else self.spark.createDataFrame([], _ENTRY)

    def add(self, snap: DataFrame, value: str = "ns") -> int:
        """Keep the lists of `snap` that are not known yet; returns the number of the import. NULL is no list.

        Repeats are dropped before the shuffle, so a list that most rows have costs no more than another one.
        """
        version, known, before = self.versions(), self.lists(), self.shared()
        # with the hash from the start, so that one shuffle serves both this and the comparison with the known lists
        lists = snap.where(F.col(value).isNotNull()).select(list_hash(F.col(value)).alias("hash"), F.col(value).alias("ns")).distinct()
        fresh = lists.join(known, ["hash", "ns"], "left_anti")
        taken = known.groupBy("hash").agg((F.max("no") + 1).alias("taken"))
        place = F.row_number().over(Window.partitionBy("hash").orderBy(F.to_json(F.struct("ns")))) - 1
        numbered = fresh.join(taken, "hash", "left").select("hash", (place + F.coalesce("taken", F.lit(0))).cast("int").alias("no"), "ns")
        numbered.write.mode("overwrite").parquet(self._path("lists", version))
        added = self.spark.read.schema(_ENTRY).parquet(self._path("lists", version))
        hashes = added.where("no > 0").select("hash").distinct()
        met = known.unionByName(added).join(hashes, "hash", "left_semi")
        before.unionByName(met).distinct().write.mode("overwrite").parquet(self._path("shared", version))
        return version

    def encode(self, snap: DataFrame, value: str = "ns") -> DataFrame:
        """`snap` with `ns_hash` and `ns_no` instead of the list (both NULL for NULL); its lists must have been added."""
        few = self.shared().select(F.col("hash").alias("ns_hash"), F.col("no").alias("_no"), F.col("ns").alias("_ns"))
        known = F.col(value).isNotNull()
        own = snap.withColumn("ns_hash", F.when(known, list_hash(F.col(value))))
        found = own.alias("o").join(few.alias("f"), (F.col("o.ns_hash") == F.col("f.ns_hash")) & (F.col(f"o.{value}") == F.col("f._ns")), "left")
        kept = [F.col(f"o.{c}") for c in snap.columns if c != value]
        return found.select(*kept, F.col("o.ns_hash"), F.when(F.col(f"o.{value}").isNotNull(), F.coalesce("f._no", F.lit(0))).alias("ns_no"))

    def decode(self, rows: DataFrame, value: str = "ns") -> DataFrame:
        """The list back for `ns_hash` and `ns_no`; NULL for NULL."""
        entries = self.lists().select(F.col("hash").alias("ns_hash"), F.col("no").alias("ns_no"), F.col("ns").alias(value))
        return rows.join(entries, ["ns_hash", "ns_no"], "left").drop("ns_hash", "ns_no")


def diff_encoded(prev: DataFrame, cur: DataFrame, lists: ListDictionary, key: Sequence[str] = ("domain",), value: str = "ns") -> DataFrame:
    """What `diff_snapshots` gives for two encoded snapshots: ids are compared, and the lists of new and changed rows looked up."""
    ids, side = ["ns_hash", "ns_no"], F.struct("ns_hash", "ns_no")
    joined = cur.select(*key, side.alias("_now")).join(prev.select(*key, side.alias("_old")), list(key), "full_outer")
    changed = joined.where(~F.col("_now").eqNullSafe(F.col("_old")))
    there = lists.decode(changed.where("_now is not null").select(*key, *[F.col(f"_now.{c}").alias(c) for c in ids]), value)
    gone = changed.where("_now is null").select(*key, F.array().cast("array<string>").alias(value))
    return there.select(*key, value).unionByName(gone)
