"""Sharding by jump consistent hashing: a stable key and the number of shards decide, without a ring table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import storage, words

SLOT_BLOCKS = 256


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. Growing from n to n + 1 shards moves keys only into the new one, about 1 in n + 1."""
    key = words.mix(keys.astype(np.uint64))
    shard = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        shard[open_] = ahead[open_]
        key[open_] = key[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (key[open_] >> np.uint64(33)).astype(np.float64) + 1
        ahead[open_] = ((shard[open_] + 1) * (float(1 << 31) / step)).astype(np.int64)
        open_ = open_[ahead[open_] < shards]
    return shard


def assign(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shard, and slot in it, of each row; one output row per input row.

    doc_id, size (UTF-8 bytes of the text, none for NULL, plus 16), text_crc32 (of the UTF-8 text; 0 for NULL, as for
    an empty one), law `key`, shard (0 to shards - 1), slot (from 0 without gaps in each shard), grown_shard (with one
    more shard). Rows that share a doc_id, or have none (key 0), get the same shard, as the law asks. Slots are dealt in 256
    hashed blocks per shard, so no task numbers a whole shard; equal rows are interchangeable. Other columns are ignored.
    """
    path = storage.run_dir(docs.sparkSession, "shards")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(0).to_numpy()
            now, grown = (pa.array(jump(keys, n).astype(np.int32)) for n in (shards, shards + 1))
            size, crc = (batch.column(i).to_numpy().astype(np.uint64) for i in (1, 2))
            block = words.mix(words.mix(keys.astype(np.uint64)) + (crc << np.uint64(32)) + size) % np.uint64(SLOT_BLOCKS)
            yield pa.RecordBatch.from_arrays([*batch.columns, now, grown, pa.array(block.astype(np.int32))],
                                             names=[*batch.schema.names, "shard", "grown_shard", "block"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    light = light.mapInArrow(both, "doc_id long, size long, text_crc32 long, shard int, grown_shard int, block int")
    light = storage.kept(light, f"{path}/light")
    counts = light.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "block", F.expr("sum(n) over (partition by shard order by block) - n").alias("before"))
    # at most shards x 256 rows
    placed = light.join(F.broadcast(before), ["shard", "block"])
    slot = F.expr("row_number() over (partition by shard, block order by doc_id, text_crc32, size)") - 1 + F.col("before")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.cast("long").alias("slot"), "grown_shard")
