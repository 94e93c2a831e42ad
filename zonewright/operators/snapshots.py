"""Zone snapshots and the difference of two of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.operators import skew


def zone_snapshot(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Records `(domain, ns)` to one row per domain with its sorted servers, repeats kept."""
    return skew.sorted_lists(records, [*by, "domain"], "ns")


def diff_snapshots(prev: DataFrame, cur: DataFrame, by: Sequence[str] = (), value: str = "ns") -> DataFrame:
    """New and changed rows with their list now, removed rows with []; equal rows dropped.

    Both sides hold one row per key, so no key is hot. A full outer join: nothing is assumed about
    the order of the files.
    """
    key = [*by, "domain"]
    joined = cur.select(*key, value, F.lit(True).alias("_in")).join(
        prev.select(*key, F.col(value).alias("_old"), F.lit(True).alias("_was")), key, "full_outer")
    # presence decides, not the list: a removed row may have had none
    changed = joined.where(F.col("_in").isNull() | F.col("_was").isNull() | ~F.col(value).eqNullSafe(F.col("_old")))
    return changed.select(*key, F.when(F.col("_in"), F.col(value)).otherwise(F.array().cast("array<string>")).alias(value))


def removed_keys(prev: DataFrame, cur: DataFrame, key: Sequence[str] = ("domain",)) -> DataFrame:
    return prev.select(*key).join(cur.select(*key), list(key), "left_anti")


def change_count(prev: DataFrame, cur: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of changes an import would send, per `by` (or in all), without sending any."""
    return diff_snapshots(prev, cur, by).groupBy(*by).agg(F.count(F.lit(1)).alias("changes"))
