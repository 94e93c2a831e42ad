"""Keys that hold a large part of all rows: salted joins and ordered scans in blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.session import checkpointed

SALTS = 16


def salted_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], spread: Column,
                how: str = "left", salts: int = SALTS, hot: DataFrame | None = None) -> DataFrame:
    """Join many facts to at most one dim row per key when one key may hold most facts.

    Facts of a key are spread over `salts` partitions by a hash of `spread` (something that differs
    between facts of one key); each dim row is repeated once per salt. `dim` must already be
    reduced to one row per key, so the repetition is salts x distinct keys, whatever the facts are.
    The rows are repeated by a cross join with the salts: Spark then plans with the size of the repeated side
    (an explode counts as one row each), and does not broadcast a side that only was small before.
    With `hot`, rows `(on..., _hot)` of the few keys that hold many facts (broadcast), only these are spread and repeated.
    """
    on = list(on)
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    if hot is not None:
        few = F.broadcast(hot)
        numbers = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        left = facts.join(few, on, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
        right = dim.join(few, on, "left").withColumn("_salt", F.explode(numbers)).drop("_hot")
        return left.join(right, [*on, "_salt"], how).drop("_salt")
    left = facts.withColumn("_salt", salt)
    right = dim.crossJoin(dim.sparkSession.range(salts).select(F.col("id").cast("int").alias("_salt")))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def spread_scan(scan: DataFrame) -> DataFrame:
    """A scan's rows dealt out evenly when it has fewer splits than the cluster has cores.

    For costly work on each row of a few unsplittable files. With enough splits nothing is moved.
    Only for plain scans: counting the splits of anything with a shuffle would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def in_blocks(df: DataFrame, key: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Rows range-partitioned by key and order, stored once, with `_block`: the number of the row's range.

    The ranges follow the ranks of the rows over all of `key` and `order`, so a key with many rows, many
    equal or NULL order values or a far outlier covers as many ranges as it has rows for; only rows that
    agree in the key and in every order column stay together. Order columns may be of any sortable type.
    The bounds come from a sample, so the rows are checkpointed with their block: whatever is
    computed again later, or after an executor was lost, sees the same blocks. `blocks` defaults to the
    session's shuffle partitions, merged by adaptive execution where there is little data.
    """
    sort = [F.col(c).asc_nulls_first() for c in [*key, *order]]
    placed = df.repartitionByRange(*([blocks] if blocks else []), *sort)
    return checkpointed(placed.withColumn("_block", F.spark_partition_id()))


def _carry(keyed: DataFrame, newest: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """`(_k, _block, carried...)` for the first key of every block, from the earlier blocks that it fills.

    Only the last key of a block can go on in the next one. `newest` are aggregates over a block that each
    give a struct `(k, v)`; v counts if k is the last key. So one row per block is left after one aggregate,
    and the window for `carried` runs over twice as many rows as there are blocks.
    """
    ends = keyed.groupBy("_block").agg(F.min("_k").alias("_first"), F.max("_k").alias("_last"),
                                       *[c.alias(n) for n, c in newest.items()])
    of_last = [F.when(F.col(n)["k"] == F.col("_last"), F.col(n)["v"]).alias(n) for n in newest]
    none = [F.when(F.lit(False), F.col(n)["v"]).alias(n) for n in newest]
    both = ends.select("_block", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("_first").alias("_k"), *none),
                                                   F.struct(F.lit(1).alias("end"), F.col("_last").alias("_k"), *of_last))).alias("e"))
    before = Window.partitionBy("_k").orderBy("_block", "end").rowsBetween(Window.unboundedPreceding, -1)
    return (both.select("_block", "e.*").select("_k", "_block", "end", *[c.over(before).alias(n) for n, c in carried.items()])
            .where("end = 0").drop("end"))


def running_last(df: DataFrame, key: Sequence[str], order: Sequence[str], values: dict[str, Column],
                 include_current: bool = True, blocks: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """For every row, the latest non-NULL of each expression over the key's rows up to this one.

    With `include_current=False` only earlier rows count. Wrap a value in a struct to let it be
    NULL itself. Rows of a key are ordered by all of `order`. The rows are stored once in ordered
    blocks (`in_blocks`); inside a block a window gives the value, and into the next block the last values
    of the one key that goes on are carried over (one row per block, so that side is broadcast). `keep` are
    the columns to carry along (all by default), key and order among them.
    """
    key, order, names, keep = list(key), list(order), list(values), list(df.columns if keep is None else keep)
    blocked = in_blocks(df.select(*keep, *[v.alias(f"_v_{n}") for n, v in values.items()]), key, order, blocks)
    keyed = blocked.withColumn("_k", F.struct(*key))
    frame = (Window.partitionBy(*key, "_block").orderBy(*[F.col(o).asc_nulls_first() for o in order])
             .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1))
    inner = keyed.select("*", *[F.last(f"_v_{n}", ignorenulls=True).over(frame).alias(f"_l_{n}") for n in names])

    def newest(n: str) -> Column:
        held = F.struct(F.col(f"_v_{n}").alias("v"))  # NULL only where no value was found, not where the value is NULL
        return F.max_by(F.struct(F.col("_k").alias("k"), held.alias("v")),
                        F.when(F.col(f"_v_{n}").isNotNull(), F.struct("_k", *order)))

    carry = _carry(keyed, {f"_p_{n}": newest(n) for n in names},
                   {f"_c_{n}": F.last(f"_p_{n}", ignorenulls=True) for n in names})
    joined = inner.join(F.broadcast(carry), ["_k", "_block"], "left")
    return joined.select(*keep, *[F.coalesce(F.col(f"_l_{n}"), F.col(f"_c_{n}")["v"]).alias(n) for n in names])


def arrival_number(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "seq",
                   blocks: int | None = None) -> DataFrame:
    """Number the rows of each key 1, 2, ... in `order`, block by block as in `running_last`."""
    key, order = list(key), list(order)
    keyed = in_blocks(df, key, order, blocks).withColumn("_k", F.struct(*key))
    within = Window.partitionBy(*key, "_block").orderBy(*[F.col(o).asc_nulls_first() for o in order])
    numbered = keyed.withColumn("_rn", F.row_number().over(within).cast("bigint"))
    carry = _carry(numbered, {"_n": F.max(F.struct(F.col("_k").alias("k"), F.col("_rn").alias("v")))}, {"_before": F.sum("_n")})
    return (numbered.join(F.broadcast(carry), ["_k", "_block"], "left")
            .select(*df.columns, (F.col("_rn") + F.coalesce(F.col("_before"), F.lit(0))).alias(name)))


def sorted_lists(df: DataFrame, key: Sequence[str], value: str, kinds: dict[str, Column] | None = None,
                 with_value: Sequence[str] = (), greatest: dict[str, Column] | None = None,
                 more: Sequence[Column] = ()) -> DataFrame:
    """Sorted lists of `value` per key with repeats kept: one list, or one per condition in `kinds`.

    Repeats are counted before the shuffle on the key, so a key whose rows repeat a few values
    arrives as those few values with their counts. In the same pass `greatest` gives the maximum
    of other expressions, and `more` further aggregates over the distinct values; these may use
    `with_value` (columns that follow from the value) and the conditions, as `_is_<name>`.
    """
    key, greatest = list(key), greatest or {}
    flags = kinds or {value: F.lit(True)}
    tagged = df.select(*key, *with_value, F.col(value).alias("_value"), *[c.alias(f"_is_{n}") for n, c in flags.items()],
                       *[c.alias(f"_max_{n}") for n, c in greatest.items()])
    marks = [f"_is_{n}" for n in flags]
    counted = tagged.groupBy(*key, "_value", *with_value, *marks).agg(
        F.count(F.lit(1)).cast("int").alias("_times"), *[F.max(f"_max_{n}").alias(f"_max_{n}") for n in greatest])

    def as_list(n: str) -> Column:
        pairs = F.collect_list(F.when(F.col(f"_is_{n}") & F.col("_value").isNotNull(), F.struct("_value", "_times")))
        return F.flatten(F.transform(F.array_sort(pairs), lambda p: F.array_repeat(p["_value"], p["_times"]))).alias(n)

    return counted.groupBy(*key).agg(*[as_list(n) for n in flags], *[F.max(f"_max_{n}").alias(n) for n in greatest], *more)
