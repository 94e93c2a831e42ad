"""Version history: what changed from one version of a row to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.operators import skew

BOOKKEEPING = ("last_modified", "ns_domains")  # left out of the shown table


def _as_text(name: str, df: DataFrame) -> Column:
    kind = dict(df.dtypes)[name]
    return F.to_json(F.col(name)) if kind.startswith("array") else F.col(name).cast("string")


def with_previous(log: DataFrame, cols: Sequence[str], key: str = "domain",
                  order: Sequence[str] = ("last_modified", "seq"), blocks: int | None = None) -> DataFrame:
    """Add `_prev`: struct of `cols` in the key's version before this one, NULL for the first."""
    whole = F.struct(*[F.col(c) for c in cols])
    return skew.running_last(log, [key], order, {"_prev": whole}, include_current=False, blocks=blocks)


def _history(log: DataFrame, cols: Sequence[str], key: str, order: Sequence[str], blocks: int | None) -> DataFrame:
    texts = log.select(key, *order, *[_as_text(c, log).alias(f"_t_{c}") for c in cols])
    prev = with_previous(texts, [f"_t_{c}" for c in cols], key, order, blocks)
    first = F.col("_prev").isNull()
    changes = F.array_compact(F.array(*[
        F.when(first | ~F.col(f"_t_{c}").eqNullSafe(F.col("_prev")[f"_t_{c}"]),
               F.struct(F.lit(c).alias("field"), F.col("_prev")[f"_t_{c}"].alias("before"),
                        F.col(f"_t_{c}").alias("after"))) for c in cols]))
    return (prev.withColumn("is_first", first).withColumn("changes", changes).where(F.size("changes") > 0))


def change_history(log: DataFrame, cols: Sequence[str], key: str = "domain",
                   order: Sequence[str] = ("last_modified", "seq"), blocks: int | None = None) -> DataFrame:
    """Per version the changed fields with values before and after, as text; unchanged versions dropped.

    The first version of a key lists every field. Output: key, order columns, `is_first`,
    `changes array<struct<field,before,after>>`.
    """
    return _history(log, cols, key, order, blocks).select(key, *order, "is_first", "changes")


def change_table(log: DataFrame, cols: Sequence[str], key: str = "domain",
                 order: Sequence[str] = ("last_modified", "seq"), source: str = "modified_by",
                 blocks: int | None = None) -> DataFrame:
    """One row per changed field: key, order columns, source, field, before, after.

    Before the first version stands N/A. Bookkeeping fields are shown for first versions only.
    """
    watched = [source, *[c for c in cols if c != source]]
    listed = (_history(log, watched, key, order, blocks)
              .select(key, *order, F.col(f"_t_{source}").alias(source), "is_first", F.explode("changes").alias("_c")))
    shown = listed.where(F.col("is_first") | ~F.col("_c.field").isin(*BOOKKEEPING))
    before = F.when(F.col("is_first"), F.lit("N/A")).otherwise(F.col("_c.before"))
    return shown.select(key, *order, source, F.col("_c.field").alias("field"), before.alias("before"),
                        F.col("_c.after").alias("after"))


def validity(log: DataFrame, key: str = "domain", order: Sequence[str] = ("last_modified", "seq"), blocks: int | None = None) -> DataFrame:
    """Every version with `valid_from` and `valid_to`, the time of the key's next version (NULL for the newest).

    The first of `order` is the time, the rest decide between versions of one time, of which only the last is ever valid. Versions without
    a time come before all others; what such a one supersedes ended in the year 1.
    """
    at, *rest = order
    back = {"_b0": -F.unix_micros(F.col(at).cast("timestamp")), **{f"_b{i + 1}": -F.col(c) for i, c in enumerate(rest)}}
    # a NULL time is the earliest, so it comes last on the way back
    turned = log.withColumn("_none", F.col(at).isNull()).withColumns(back)
    found = skew.running_last(turned, [key], ["_none", *back], {"_next": F.struct(F.col(at).alias("at"))}, include_current=False, blocks=blocks)
    superseded = F.when(F.col("_next").isNotNull(), F.coalesce(F.col("_next")["at"], F.lit("0001-01-01").cast(dict(log.dtypes)[at])))
    return found.select(*log.columns, F.col(at).alias("valid_from"), superseded.alias("valid_to"))


def write_validity(intervals: DataFrame, path: str) -> None:
    """Store `validity` rows by the month they ended in, so that a read as of a day leaves out the folders of earlier months."""
    intervals.withColumn("ended", F.trunc(F.to_date("valid_to"), "month")).write.partitionBy("ended").mode("errorifexists").parquet(path)


def as_of_day(intervals: DataFrame, day: str) -> DataFrame:
    """The table as it was at the end of a day: one row per key that had a version by then."""
    end = F.date_add(F.lit(day).cast("date"), 1)
    begun = F.col("valid_from").isNull() | (F.col("valid_from") < end)
    open_ = F.col("valid_to").isNull() | (F.col("valid_to") >= end)
    if "ended" in intervals.columns:
        intervals = intervals.where(F.col("ended").isNull() | (F.col("ended") >= F.trunc(F.lit(day).cast("date"), "month"))).drop("ended")
    return intervals.where(begun & open_).drop("valid_from", "valid_to")


def domain_changes(log: DataFrame, domain: str, cols: Sequence[str]) -> DataFrame:
    """The change table of one name, newest first."""
    table = change_table(log.where(F.col("domain") == domain), cols)
    return table.orderBy(F.col("last_modified").desc_nulls_last(), F.col("seq").desc_nulls_last(), "field")
