"""Result, request and error messages: reading streams of them and writing them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.functions import text

MESSAGE = "topic string, key string, value string, offset bigint, timestamp timestamp"


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Message stream `(topic, key, value, offset, timestamp)` from Kafka, or from files of that shape."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select("topic", F.col("key").cast("string"), F.col("value").cast("string"), "offset",
                                    "timestamp")
    return reader.schema(MESSAGE).load(path)


def result_messages(messages: DataFrame, topic: str = "results") -> DataFrame:
    """Messages of the result topic as `(seq, key, value, arrived)`; the key in lower case."""
    return messages.where(F.col("topic") == topic).select(
        F.col("offset").alias("seq"), F.lower("key").alias("key"), "value", F.col("timestamp").alias("arrived"))


def request_messages(messages: DataFrame, pattern: str = r"^scrape\..*") -> DataFrame:
    """Scrape requests by topic pattern; `scraper` and `shard` are read off the topic."""
    parts = F.split("topic", r"\.", 3)
    return messages.where(F.col("topic").rlike(pattern)).select(
        "topic", "key", "value", F.get(parts, F.lit(1)).alias("scraper"), F.get(parts, F.lit(2)).alias("shard"),
        "offset", "timestamp")


def _error(doc: Column) -> dict[str, Column]:
    return {"error": doc["error"], "error_type": doc["error_type"], "file": doc["file"],
            "line": doc["line"].try_cast("int"), "traceback": doc["traceback"], "scraper": doc["scraper"],
            "topic": doc["topic"], "timestamp": text.iso_timestamp(doc["timestamp"])}


def error_rows(messages: DataFrame, topic: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(error rows with a fresh uuid, unreadable messages)."""
    tagged = messages.where(F.col("topic") == topic).withColumn("_doc", F.from_json("value", "map<string,string>"))
    fields = _error(F.col("_doc"))
    ok = F.col("_doc").isNotNull() & fields["timestamp"].isNotNull()
    rows = tagged.where(ok).select(F.uuid().alias("uuid"), F.lower("key").alias("domain"),
                                   *[c.alias(n) for n, c in fields.items()])
    bad = tagged.where(~F.coalesce(ok, F.lit(False))).select(
        "key", "value", F.lit("not an error message").alias("reason"))
    return rows, bad


def append_errors(rows: DataFrame, path: str) -> None:
    (rows.withColumn("day", F.to_date("timestamp")).write.mode("append").partitionBy("day").parquet(path))


def append_history(versions: DataFrame, path: str) -> None:
    """Every version with its day; reads of a span of days touch only those folders."""
    versions.withColumn("date", F.to_date("last_modified")).write.mode("append").partitionBy("date").parquet(path)


def write_messages(messages: DataFrame, fmt: str, options: Mapping[str, str], path: str | None = None) -> None:
    """`(key, value[, topic])` to Kafka, or to files."""
    writer = messages.write.format(fmt).options(**options).mode("append")
    writer.save() if path is None else writer.save(path)


def spread_evenly(messages: DataFrame, partitions: int) -> DataFrame:
    """Round robin over sink partitions: by key they would come out uneven."""
    return messages.repartition(partitions)


def empty_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.ERROR_SCHEMA)
