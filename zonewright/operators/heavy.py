"""Most frequent values from mergeable summaries, with a certificate that they are the right ones.

A task keeps at most `capacity` counters. When there are more, the next largest count is taken off all of them and those that
reach zero go; what was taken off in all is the task's error. Added up over tasks, a value's counters are a lower bound of its
count, and no count is more than the sum of the errors above it. So if the kth lower bound is above that sum, the k most
frequent values are among those whose upper bound reaches it; these are counted exactly. Otherwise all values are counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators import search

CAPACITY = 8_192


def reduced(values: pa.Array, counts: np.ndarray, capacity: int) -> tuple[pa.Array, np.ndarray, int]:
    """At most `capacity` counters, and what was taken off each: the next largest count."""
    if len(counts) <= capacity:
        return values, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = np.flatnonzero(counts > off)
    return values.take(pa.array(left)), counts[left] - off, off


def summaries(values: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(value, count, error): counters of the text column `v` from each task, and a row without a value for its error.

    They may be stored, and united with those of other rows; `merged` adds them up. NULL is no value.
    """
    schema = pa.schema([("value", pa.string()), ("count", pa.int64()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, error = pa.array([], pa.string()), np.zeros(0, np.int64), 0

        def fold(parts: list[pa.Array]) -> None:
            nonlocal held, counts, error
            got = pc.value_counts(pa.concat_arrays(parts))
            both = pa.table({"v": pa.concat_arrays([held, got.field(0)]), "n": pa.concat_arrays([pa.array(counts), got.field(1)])}).group_by("v").aggregate([("n", "sum")])
            held, counts, off = reduced(both.column("v").combine_chunks(), both.column("n_sum").to_numpy(), capacity)
            error += off

        waiting: list[pa.Array] = []
        for batch in batches:
            waiting.append(batch.column(0).drop_null())
            if sum(map(len, waiting)) >= 4 * capacity:
                fold(waiting)
                waiting = []
        if waiting:
            fold(waiting)
        if error:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([0]), pa.array([error])], schema=schema)
        if len(held):
            yield pa.RecordBatch.from_arrays([held, pa.array(counts), pa.array(np.zeros(len(held), np.int64))], schema=schema)

    return values.select(F.col("v").cast("string")).mapInArrow(run, "value string, count bigint, error bigint")


def merged(parts: DataFrame) -> tuple[DataFrame, int]:
    """((v, low), error): lower bounds of the counts, and what no count is further above its own."""
    error = parts.agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    return parts.where(F.col("value").isNotNull()).groupBy(F.col("value").alias("v")).agg(F.sum("count").alias("low")), error


def most_frequent(values: DataFrame, size: int, capacity: int = CAPACITY) -> tuple[DataFrame, bool]:
    """((v, count) of the `size` most frequent values of the text column `v`, ties by value; whether the summaries sufficed)."""
    low, error = merged(summaries(values, capacity))
    top = [r["low"] for r in low.orderBy(F.desc("low")).limit(size).collect()]
    sure = error == 0 or (len(top) == size and top[-1] > error)
    if sure and error:
        candidates = low.where(F.col("low") + F.lit(error) >= top[-1]).select("v")
        values = values.join(candidates, "v", "left_semi")
    counts = low.withColumnRenamed("low", "count") if not error else values.where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "v").limit(size), sure


def facet(df: DataFrame, col: str, criteria: Sequence[tuple[str, str, str]] = (), size: int = search.FACET_SIZE, capacity: int = CAPACITY) -> DataFrame:
    """What `search.facet` gives for a text or list column, without moving every distinct value where a few stand out."""
    top, _ = most_frequent(search.facet_values(df, col, criteria), size, capacity)
    label: Column = text.empty_label(F.col("v"))
    return top.select(label.alias("label"), "count")
