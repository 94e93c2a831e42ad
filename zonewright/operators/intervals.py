"""Networks as disjoint address ranges, and addresses matched to them in one ordered pass.

Networks nest, so at each address the most specific one counts. A sweep over the networks in address order, with the
networks that are open on a stack, cuts them into ranges that do not overlap. Ranges and addresses are then ordered together: the
last range that begins at or before an address is the only one that can hold it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.operators.enrich import ip_number
from zonewright.operators.once import once
from zonewright.operators.skew import running_last

BLOCK_BITS = 12  # networks wider than a block are cut at its borders, so that blocks are swept on their own
_RANGE = pa.schema([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def network_ranges(table: DataFrame, value: str) -> DataFrame:
    """(start, end, bits, value) of the networks `(network, prefix_len, <value>)` that have an IPv4 address and a value.

    Of networks that are alike the greatest value counts. Bits of the address beyond the prefix are ignored.
    """
    bits = F.col("prefix_len").cast("int")
    sized = once(table.select(bits.alias("bits"), F.col(value).cast("string").alias("value"), ip_number(F.col("network")).alias("_n")),
                 _size=F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - F.col("bits")))
    fits = F.col("_n").isNotNull() & F.col("value").isNotNull() & F.col("bits").between(0, 32)
    start = F.col("_n") - F.pmod(F.col("_n"), F.col("_size"))
    return (sized.where(fits).groupBy(start.alias("start"), (start + F.col("_size") - 1).alias("end"), "bits").agg(F.max("value").alias("value")))


def sweep(nested: Iterator[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Disjoint ranges, in order, of ranges that nest: at each place the innermost one. They come by start, outer ones first.

    Holds the open ranges only, at most one per prefix length.
    """
    open_: list[tuple[int, str]] = []
    at = 0
    for start, end, value in nested:
        while open_ and open_[-1][0] < start:
            last, held = open_.pop()
            if at <= last:
                yield at, last, held
                at = last + 1
        if open_ and at < start:
            yield at, start - 1, open_[-1][1]
        at = start
        open_.append((end, value))
    while open_:
        last, held = open_.pop()
        if at <= last:
            yield at, last, held
            at = last + 1


def flattened(ranges: DataFrame) -> DataFrame:
    """(start, end, value) without overlap from `network_ranges`, swept block by block in sorted order."""
    size = 1 << (32 - BLOCK_BITS)
    block = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor(F.col("end") / size)))
    cut = (ranges.withColumn("block", block).withColumn("start", F.greatest("start", F.col("block") * size))
           .withColumn("end", F.least("end", F.col("block") * size + (size - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, str]]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        held: list[tuple[int, int, str]] = []
        for r in sweep(rows()):  # blocks are disjoint ranges themselves, so one sweep does for all of a task
            held.append(r)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RANGE)], schema=_RANGE)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RANGE)], schema=_RANGE)

    dealt = cut.repartition("block").sortWithinPartitions("start", "bits").select("start", "end", "value")
    return dealt.mapInArrow(run, "start bigint, end bigint, value string")


def range_lookup(addresses: DataFrame, networks: dict[str, tuple[DataFrame, str]], blocks: int | None = None) -> DataFrame:
    """`(addr, <out>...)`: what `longest_prefix` gives, by one ordered pass over addresses and ranges of all tables.

    Each address is one row, however many prefix lengths are in use. Rows are dealt out in ranges of addresses that hold as many
    rows each; the range that goes on from one part to the next is carried over.
    """
    numbered = once(addresses.select("addr"), _at=ip_number(F.col("addr"))).where(F.col("_at").isNotNull())
    events = numbered.select(F.lit(0).alias("_one"), "_at", F.lit("~").alias("_kind"), "addr", F.lit(None).cast("bigint").alias("_end"),
                             F.lit(None).cast("string").alias("_value"))
    tables = []
    for i, (table, value) in enumerate(networks.values()):
        ranges = flattened(network_ranges(table, value))
        tables.append(ranges.select(F.lit(0).alias("_one"), F.col("start").alias("_at"), F.lit(str(i)).alias("_kind"), F.lit(None).cast("string").alias("addr"),
                                    F.col("end").alias("_end"), F.col("value").alias("_value")))

    def begun(i: int) -> Column:
        return F.when(F.col("_kind") == str(i), F.struct(F.col("_end").alias("end"), F.col("_value").alias("value")))

    seen = running_last(reduce(DataFrame.unionByName, [events, *tables]), ["_one"], ["_at", "_kind"],
                        {f"_r{i}": begun(i) for i in range(len(networks))}, blocks=blocks)
    held = [F.when(F.col(f"_r{i}")["end"] >= F.col("_at"), F.col(f"_r{i}")["value"]).alias(out) for i, out in enumerate(networks)]
    found = seen.where("_kind = '~'").select("addr", *held)
    return found.where(reduce(lambda a, b: a | b, [F.col(out).isNotNull() for out in networks]))
