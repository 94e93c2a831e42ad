"""Substring search by an inverted index of trigrams.

Index of a text or list column, stored in three tables: grams (gram, id) over the distinct values, values (id, value), and rows (id,
key). A pattern's rarest trigrams are read, their lists of values intersected, and the values that are left checked by the
exact predicate; only then are rows looked up. Patterns under three letters are looked for in all distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAREST = 4  # trigrams of a pattern that are intersected; the predicate decides, so more only save checks
GROUP_BYTES = 1 << 22


def _grams(value: Column) -> Column:
    """Distinct runs of three characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(value) - 2, F.lit(1)))
    return F.array_distinct(F.filter(F.transform(at, lambda i: F.substring(value, i, F.lit(3))), lambda g: F.length(g) == 3))


def write_index(df: DataFrame, col: str, path: str, key: str = "domain") -> None:
    """Index `col` of `df` under `path`; rows without a value are in no list. Sorted files let a search read its own trigrams only."""
    values = df.select(F.col(key).alias("key"), (F.explode(col) if dict(df.dtypes)[col].startswith("array") else F.col(col)).alias("value"))
    rows = values.where(F.col("value").isNotNull()).select(F.xxhash64("value").alias("id"), "value", "key").distinct()
    options = {"parquet.block.size": str(GROUP_BYTES)}
    rows.repartitionByRange("id", "value", "key").sortWithinPartitions("id").write.options(**options).parquet(f"{path}/rows")
    spark = df.sparkSession
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    distinct = stored.select("id", "value").distinct()
    grams = distinct.select(F.explode(_grams(F.col("value"))).alias("gram"), "id").distinct()
    grams.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id").write.options(**options).parquet(f"{path}/grams")
    counts = spark.read.schema("gram string, id bigint").parquet(f"{path}/grams").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.sort("gram").write.parquet(f"{path}/counts")
    distinct.repartitionByRange("id").sortWithinPartitions("id").write.options(**options).parquet(f"{path}/values")


def candidates(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(id) of the values that hold the pattern's rarest trigrams."""
    grams = sorted({pattern[i : i + 3] for i in range(len(pattern) - 2)})
    counted = {r["gram"]: r["n"] for r in spark.read.schema("gram string, n bigint").parquet(f"{path}/counts").where(F.col("gram").isin(grams)).collect()}
    postings = spark.read.schema("gram string, id bigint").parquet(f"{path}/grams")
    if len(counted) < len(grams):
        return postings.select("id").limit(0)
    chosen = sorted(grams, key=lambda g: (counted[g], g))[:RAREST]
    found = postings.where(F.col("gram").isin(chosen)).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return found.where(F.col("n") == len(chosen)).select("id")


def search_values(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(id, value) of the distinct values that hold the pattern, letter for letter."""
    values = spark.read.schema("id bigint, value string").parquet(f"{path}/values")
    if len(pattern) >= 3:
        values = values.join(candidates(spark, path, pattern), "id", "left_semi")
    return values.where(F.col("value").contains(pattern))


def search_keys(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(key) of the rows with such a value, each once: what an exact `substring` search selects."""
    rows = spark.read.parquet(f"{path}/rows")
    found = search_values(spark, path, pattern)
    return rows.join(found, ["id", "value"], "left_semi").select("key").distinct()
