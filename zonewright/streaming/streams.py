"""Structured Streaming jobs: upserts with history and follow-ups, error ingest, request rates."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonewright.operators.merge import apply_updates, decode_updates
from zonewright.operators.names import Suffixes
from zonewright.operators.reports import rate_parts
from zonewright.operators.selection import follow_ups
from zonewright.sources import messages as msg
from zonewright.streaming.store import VersionStore


BATCH_ROWS = 50_000  # messages a task decodes: a message becomes a row of all columns, many times as wide


def _spread(messages: DataFrame) -> DataFrame:
    """A batch in as many parts as its rows need. Its files are split by their size, and messages pack far tighter than rows."""
    parts = -(-messages.count() // BATCH_ROWS)
    return messages.repartition(parts) if parts > 1 else messages


def upsert_batch(store: VersionStore, results: DataFrame, batch_id: int, suffixes: Suffixes,
                 enrich: Callable[[DataFrame], DataFrame] | None = None,
                 type_names: Mapping[str, str] | None = None,
                 send: Callable[[DataFrame, int], None] | None = None) -> None:
    """One micro-batch of result messages `(seq, key, value, arrived)` into the store.

    Every output is written under the batch id and replaced if the batch runs again, and stored
    rows are read as they were before it, so a batch counts once however often it is run.
    """
    updates, bad = decode_updates(_spread(results), type_names)
    updates = updates.persist()
    try:
        current = store.current(before=batch_id, touched=updates)
        versions, rejected = apply_updates(current, updates, suffixes, enrich)
        store.append(versions, batch_id)
        store.side_output(bad.unionByName(rejected), "quarantine", batch_id)
        requests = follow_ups(updates, suffixes)
        if send is None:
            store.side_output(requests, "requests", batch_id)
        else:
            send(requests, batch_id)
    finally:
        updates.unpersist()


def stream_updates(messages: DataFrame, store: VersionStore, checkpoint: str, suffixes: Suffixes,
                   enrich=None, type_names=None, send=None, compact_every: int | None = None,
                   trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Continuous upsert of the result topic. Size batches with the source's own limits
    (maxOffsetsPerTrigger, maxFilesPerTrigger); `trigger` defaults to one batch a second. With a new
    checkpoint the source is read again, and its batches follow those in the store."""

    started, running = threading.Event(), []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not started.wait(600):
            raise RuntimeError("the query did not start")
        number = store.first_batch(str(running[0].id)) + batch_id
        upsert_batch(store, batch, number, suffixes, enrich, type_names, send)
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact(number)

    writer = msg.result_messages(messages).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    running.append(writer.trigger(**(trigger or {"processingTime": "1 second"})).start())
    started.set()
    return running[0]


def stream_errors(messages: DataFrame, path: str, checkpoint: str, quarantine: str,
                  trigger: Mapping[str, object] | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Error topic appended to the error log, by day, and its unreadable messages to `quarantine`.

    Two queries, each with its own checkpoint below `checkpoint`; the file sinks commit each batch once.
    """
    rows, bad = msg.error_rows(messages)
    trigger = trigger or {"processingTime": "1 second"}
    log = (rows.withColumn("day", F.to_date("timestamp")).writeStream.format("parquet").partitionBy("day").outputMode("append")
           .option("path", path).option("checkpointLocation", f"{checkpoint}/errors"))
    unread = (bad.writeStream.format("parquet").outputMode("append")
              .option("path", quarantine).option("checkpointLocation", f"{checkpoint}/quarantine"))
    return log.trigger(**trigger).start(), unread.trigger(**trigger).start()


def stream_request_rate(requests: DataFrame, target: str, ts: str, capacity: float, *, unit: str = "1 second",
                        unit_seconds: int = 1, late: str = "10 seconds", at: float = 0.0) -> DataFrame:
    """Sliding-window load per target as a streaming aggregate; a window is given out once it is closed.

    As in the batch report each request counts for its own window and for the next one's previous.
    """
    parts = rate_parts(requests, target, ts, unit_seconds)
    stamped = parts.withColumn("at", F.timestamp_seconds(F.col("slot") * unit_seconds)).withWatermark("at", late)
    counts = (stamped.groupBy("target", F.window("at", unit).alias("w"))
              .agg(F.sum("cur").alias("cur_count"), F.sum("prev").alias("prev_count")).where(F.col("cur_count") > 0))
    load = F.col("prev_count") * F.lit(1.0 - at) + F.col("cur_count")
    return counts.select("target", F.col("w.start").alias("window_start"), "cur_count", "prev_count",
                         load.alias("load"), (load > capacity).alias("over_limit"))
