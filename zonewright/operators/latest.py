"""Newest version of every key, and what is read off that view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright import schema


def latest_by_key(log: DataFrame, key: str = "domain", order: Sequence[str] = ("last_modified", "seq"),
                  cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the version that is greatest in `order`.

    An aggregate, not a window, so versions are reduced before the shuffle and a key with very many
    versions costs no more than one row per task. Name `cols` to carry only what is needed; filters
    on the key may be put before this, filters on other columns must come after.
    """
    picked = [c for c in (log.columns if cols is None else cols) if c != key]
    newest = F.max_by(F.struct(*picked), F.struct(*order)).alias("_row")
    out = log.groupBy(key).agg(newest).select(key, "_row.*")
    return out.select(*[c for c in (log.columns if cols is None else [key, *picked]) if c in out.columns])


def point_lookup(log: DataFrame, domain: str, key: str = "domain",
                 order: Sequence[str] = ("last_modified", "seq")) -> DataFrame:
    """Newest row of one key; the key filter goes to the scan, before the versions are reduced."""
    return latest_by_key(log.where(F.col(key) == domain), key, order)


def total_rows(log: DataFrame, key: str = "domain") -> DataFrame:
    """How many keys there are: needs the key column only, no version choice."""
    return log.select(key).distinct().agg(F.count(F.lit(1)).alias("count"))


def in_schema_order(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in schema.ALL_COLS if c in df.columns])


def column_group(df: DataFrame, group: str) -> DataFrame:
    """Named projection (default, dns, registrant, admin, tech, traffic, whois), key always first."""
    wanted = ["domain", *schema.COLUMN_GROUPS[group]]
    return df.select(*[c for c in wanted if c in df.columns])


def compact(log: DataFrame, path: str, key: str = "domain", order: Sequence[str] = ("last_modified", "seq"),
            buckets: int = 256) -> None:
    """Write the latest view to a new folder, split by key hash so later joins read only some of it."""
    view = latest_by_key(log, key, order).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    view.repartition(buckets, "bucket").write.partitionBy("bucket").mode("errorifexists").parquet(path)
