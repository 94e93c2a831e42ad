"""Distinct names of any span of days from one stored sketch a day.

Theta sketches: unions over days, and what one span has beyond another, come from the sketches alone. Up to 2^lg distinct names a
result is exact; beyond, its standard error is about 1 / sqrt(2^lg).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG = 14


def daily_sketches(log: DataFrame, key: str = "domain", at: str = "last_modified", lg: int = LG) -> DataFrame:
    """(day, names): a sketch of the keys of each day. Sketches of one day may be stored twice, as from two batches; a union counts keys once."""
    stamped = log.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    return stamped.groupBy(F.to_date(at).alias("day")).agg(F.theta_sketch_agg(key, lg).alias("names"))


def names_in_spans(daily: DataFrame, spans: DataFrame, lg: int = LG) -> DataFrame:
    """`spans(first, last)` with `names`: how many keys had a version on one of those days, both included; 0 if none."""
    days = spans.distinct().withColumn("day", F.explode(F.expr("if(first <= last, sequence(first, last), array(first))")))
    joined = days.join(daily, (days["day"] == daily["day"]) & (F.col("first") <= F.col("last")), "left")
    united = joined.groupBy("first", "last").agg(F.theta_union_agg("names", lg).alias("_u"), F.count("names").alias("_n"))
    return united.select("first", "last", F.when(F.col("_n") > 0, F.theta_sketch_estimate("_u")).otherwise(F.lit(0)).cast("bigint").alias("names"))


def new_names(daily: DataFrame, first: str, last: str, lg: int = LG) -> DataFrame:
    """One row, `names`: keys with a version on a day from `first` to `last` and on no day before."""
    a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
    parts = daily.where(F.col("day") <= b).agg(
        F.theta_union_agg(F.when(F.col("day") >= a, F.col("names")), lg).alias("now"), F.theta_union_agg(F.when(F.col("day") < a, F.col("names")), lg).alias("old"),
        F.count(F.when(F.col("day") >= a, 1)).alias("n"), F.count(F.when(F.col("day") < a, 1)).alias("before"))
    count = (F.when(F.col("n") == 0, F.lit(0)).when(F.col("before") == 0, F.theta_sketch_estimate("now"))
             .otherwise(F.theta_sketch_estimate(F.theta_difference("now", "old"))))
    return parts.select(count.cast("bigint").alias("names"))
