"""Current row per domain as keyed state: a micro-batch reads the state of the names it touches and nothing else.

The state is kept by Spark's RocksDB store below the checkpoint, split by key hash and saved per batch, so a restart goes on
where the last finished batch ended, whatever the size of the table. A row is kept as one packed text; state of another layout is not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from zonewright import schema
from zonewright.operators.merge import decode_updates, registered_by_resolution
from zonewright.operators.names import Suffixes, suffix_of
from zonewright.operators.once import once
from zonewright.operators.selection import follow_ups
from zonewright.sources import messages as msg
from zonewright.streaming.store import VersionStore

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "row"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that keeps stream state in RocksDB; the caller's settings stay as they are."""
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set(PROVIDER, ROCKSDB)
    return own


def _value_cols() -> list[str]:
    return [c for c in schema.TABLE_COLS if c != "domain"]


# --- packed rows -------------------------------------------------------------------------------
# Spark hands a Python processor one object per cell, so a row of all columns costs far more than what is done with it. Rows go
# there, come back and are kept as one JSON text; times are micros and dates days in it, so that nothing is rounded or shifted.
_WIRE = {"timestamp": ("bigint", F.unix_micros, F.timestamp_micros), "date": ("int", F.unix_date, F.date_from_unix_date)}


def _packed(cols: Sequence[str]) -> Column:
    """The columns that are not NULL as one JSON text."""
    def wire(c: str) -> Column:
        kind = schema.TABLE_TYPES[c]
        return (_WIRE[kind][1](F.col(c)) if kind in _WIRE else F.col(c)).alias(c)
    return F.to_json(F.struct(*map(wire, cols)))


def _unpacked(rows: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Columns `keep` of the rows and `cols` out of their `packed` text, which is read once."""
    kinds = {c: schema.TABLE_TYPES[c] for c in cols}
    ddl = ", ".join(f"{c} {_WIRE[t][0] if t in _WIRE else t}" for c, t in kinds.items())
    read = once(rows, _row=F.from_json("packed", ddl))
    return read.select(*keep, *[(_WIRE[t][2](F.col(f"_row.{c}")) if t in _WIRE else F.col(f"_row.{c}")).alias(c) for c, t in kinds.items()])


def _default(name: str):
    return [] if schema.TABLE_TYPES[name].startswith("array") else "" if name in schema.EMPTY_STRING_COLS else None


class CurrentRow(StatefulProcessor):
    """Lays each update over its domain's row, in order of arrival, and gives out the version that arises.

    The rules are those of the batch merge: a carried NULL overwrites; `tld` is filled from the name; an update of a name
    under no known suffix is refused until the row, or an update of the same batch up to this one, has given the name a suffix itself.
    Rows of one name in one micro-batch are held together, so that they can be ordered; the source's limits bound them.
    """

    def __init__(self) -> None:
        self.defaults = {c: _default(c) for c in _value_cols()}
        self.text = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState(STATE, T.StructType([T.StructField("packed", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.row.get()
        now = dict(self.defaults) if stored is None else json.loads(stored[0])
        known, packed = bool(now["tld"]), None
        for u in sorted(rows, key=lambda r: r["seq"]):
            given = json.loads(u["packed"])
            update = {c: given.get(c) for c in u["fields"].split(",") if c in self.defaults}
            known = known or bool(update.get("tld"))
            if u["_suffix"] is None and not known:
                yield Row(domain=key[0], seq=u["seq"], reason=f"unknown suffix: {key[0]}", packed=None)
                continue
            now.update(update)
            now["tld"] = now["tld"] or u["_suffix"]
            packed = self.text.encode(now)
            yield Row(domain=key[0], seq=u["seq"], reason=None, packed=packed)
        if packed is not None:
            self.row.update((packed,))

    def close(self) -> None:
        pass


def _packed_versions(updates: DataFrame, suffixes: Suffixes) -> DataFrame:
    conf = updates.sparkSession.conf
    if conf.get(PROVIDER, "") != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}, as state_session() does")
    ready = suffix_of(registered_by_resolution(updates), "domain", suffixes, "_suffix")
    slim = ready.select("domain", "seq", F.array_join("fields", ",").alias("fields"), "_suffix", _packed(_value_cols()).alias("packed"))
    return slim.groupBy("domain").transformWithState(CurrentRow(), "domain string, seq bigint, reason string, packed string", "append", "none")


def versions_of(updates: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Streaming updates to the versions that arise and the updates refused: (domain, seq, reason, columns)."""
    return _unpacked(_packed_versions(updates, suffixes), _value_cols(), ["domain", "seq", "reason"])


def stream_versions(messages: DataFrame, store: VersionStore, checkpoint: str, suffixes: Suffixes, type_names: Mapping[str, str] | None = None,
                    trigger: Mapping[str, object] | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Continuous upsert of the result topic with the current rows in state: what `stream_updates` does, without reading a base.

    Versions, refused updates and follow-up requests go to the store under the batch number, which a repeated batch
    replaces; messages that are no updates go to `quarantine` by a query of their own. Both checkpoints are below `checkpoint`.
    One checkpoint belongs to one store: its batches are numbered by it. `messages` must be read by a state_session().
    """
    good, bad = decode_updates(msg.result_messages(messages), type_names)
    trigger = trigger or {"processingTime": "1 second"}

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            versions, refused = batch.where(F.col("reason").isNull()), batch.where(F.col("reason").isNotNull())
            store.append(_unpacked(versions, _value_cols(), ["domain", "seq"]), batch_id)
            store.side_output(refused.select("seq", F.col("domain").alias("key"), F.lit(None).cast("string").alias("value"), "reason"), "refused", batch_id)
            store.side_output(follow_ups(_unpacked(versions, ["modified_by"], ["domain"]), suffixes), "requests", batch_id)
        finally:
            batch.unpersist()

    upsert = (_packed_versions(good, suffixes).writeStream.foreachBatch(run).outputMode("append").option("checkpointLocation", f"{checkpoint}/versions"))
    unread = (bad.writeStream.format("parquet").outputMode("append").option("path", f"{store.root}/quarantine")
              .option("checkpointLocation", f"{checkpoint}/quarantine"))
    return upsert.trigger(**trigger).start(), unread.trigger(**trigger).start()


def current_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The current table as the state holds it after the last finished batch; no version is read for it."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(f"{checkpoint}/versions")
    return _unpacked(state.select(F.col("key.domain").alias("domain"), F.col("value.packed").alias("packed")), _value_cols(), ["domain"])
