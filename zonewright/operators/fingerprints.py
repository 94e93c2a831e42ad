"""Snapshots kept with a tree of fingerprints, so that their difference reads only the parts that changed.

Rows lie by the hash of their key: leaves of the tree are ranges of the hash, folders hold as many leaves each. A
fingerprint is the number of rows, and the XOR and a sum of their hashes, whatever their order; an inner node adds up its
children. Two trees are compared from the root; below a node that is the same in both nothing is looked at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewright.operators.snapshots import diff_snapshots

FAN_BITS = 8
FOLDER_BITS = 8  # at most 2^FOLDER_BITS folders
MODULUS = 1 << 31


def write_snapshot(snap: DataFrame, path: str, key: Sequence[str] = ("domain",), value: str = "ns", levels: int = 2) -> None:
    """Write `(key..., value)` rows, one per key, below path/rows, their tree below path/tree, and what a reader needs in path/about.

    The tree has `levels` below its root, 2^(8 * levels) leaves: choose it so that a leaf of the largest snapshot is what one may
    read for one change.
    """
    if levels < 1 or FAN_BITS * levels > 32:
        raise ValueError("levels must be 1 to 4")
    spark = snap.sparkSession
    node = F.shiftrightunsigned(F.xxhash64(*key), 64 - FAN_BITS * levels)
    placed = snap.select(*key, value, node.alias("_node"))
    placed = placed.withColumn("_folder", F.shiftright("_node", FAN_BITS * levels - FOLDER_BITS).cast("int"))
    (placed.repartition("_folder").sortWithinPartitions("_folder", "_node", *key).write.partitionBy("_folder")
     .mode("errorifexists").parquet(f"{path}/rows"))
    about = spark.range(1).select(F.lit(levels).alias("levels"), F.lit(placed.schema.json()).alias("schema"))
    about.write.mode("errorifexists").parquet(f"{path}/about")
    # hashed as JSON: a missing list, an empty one and a missing element are all told apart
    row = F.xxhash64(*key, F.to_json(F.struct(value)))
    sums = _rows(spark, path).groupBy(F.col("_node").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.pmod(F.sum(F.pmod(row, F.lit(MODULUS))), F.lit(MODULUS)).alias("s"))
    sums.write.parquet(f"{path}/tree/level={levels}")
    for level in range(levels - 1, -1, -1):
        up = _level(spark, path, level + 1).groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(
            F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.pmod(F.sum("s"), F.lit(MODULUS)).alias("s"))
        up.write.parquet(f"{path}/tree/level={level}")


def _about(spark: SparkSession, path: str) -> Row:
    return spark.read.schema("levels int, schema string").parquet(f"{path}/about").first()


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(_about(spark, path)["schema"]))).parquet(f"{path}/rows")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema("node bigint, n bigint, x bigint, s bigint").parquet(f"{path}/tree/level={level}")


def _depth(spark: SparkSession, prev: str, cur: str) -> int:
    depths = {_about(spark, p)["levels"] for p in (prev, cur)}
    if len(depths) > 1:
        raise ValueError("the snapshots have trees of unlike depth")
    return depths.pop()


def changed_nodes(spark: SparkSession, prev: str, cur: str) -> DataFrame:
    """(node) of the leaves whose fingerprints differ, found level by level below nodes that differ."""
    differing = None
    for level in range(_depth(spark, prev, cur) + 1):
        marks = [_level(spark, p, level).select("node", F.struct("n", "x", "s").alias(side)) for p, side in ((prev, "p"), (cur, "c"))]
        if differing is not None:
            parents = differing.withColumnRenamed("node", "parent")
            marks = [m.join(parents, F.shiftright(m["node"], FAN_BITS) == parents["parent"], "left_semi") for m in marks]
        differing = marks[0].join(marks[1], "node", "full_outer").where(~F.col("p").eqNullSafe(F.col("c"))).select("node")
    return differing


def diff_stored(spark: SparkSession, prev: str, cur: str, key: Sequence[str] = ("domain",), value: str = "ns") -> DataFrame:
    """What `diff_snapshots` gives for two written snapshots, reading the folders of changed leaves only.

    The numbers of those folders (at most 256) reach the driver; inside them only rows of changed leaves are compared, and sorted files let
    the scan skip the others.
    """
    nodes = changed_nodes(spark, prev, cur)
    shift = FAN_BITS * _depth(spark, prev, cur) - FOLDER_BITS
    folders = [r[0] for r in nodes.select(F.shiftright("node", shift).cast("int")).distinct().collect()]

    def part(path: str) -> DataFrame:
        rows = _rows(spark, path).where(F.col("_folder").isin(folders) if folders else F.lit(False))
        return rows.join(nodes.withColumnRenamed("node", "_node"), "_node", "left_semi").select(*key, value)

    return diff_snapshots(part(prev), part(cur), [c for c in key if c != "domain"], value)
