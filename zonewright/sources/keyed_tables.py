"""The current table laid out by its key, so that joins on it need no shuffle and lookups read little of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 4_000_000
PUSHED_NAMES = 10  # names that Spark hands to a Parquet scan as one filter; of more only the least and the greatest
GROUP_BYTES = 16 << 20
PAGE_ROWS = 5_000


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Number of buckets for a table: the next power of two, so that tables of other sizes still fit each other bucket by bucket."""
    return 1 << max(0, (max(rows, 1) - 1) // per_bucket).bit_length()


def write_bucketed(view: DataFrame, name: str, path: str, key: str = "domain", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """`view` as table `name` at `path`, split in buckets by `key` and sorted in them; their number follows the number of rows.

    Joins and aggregates on `key` take the buckets as they are: the table's side is not moved, whatever its size. The data
    of one bucket come in one file, as each is written by one task.
    """
    spark = view.sparkSession
    buckets = buckets_for(view.count(), rows_per_bucket)
    (view.repartition(buckets, key).sortWithinPartitions(key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(name))
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; its files stay for whoever still reads them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_lookup(view: DataFrame, path: str, key: str = "domain", distinct: int | None = None, files: int | None = None,
                 group_bytes: int = GROUP_BYTES, page_rows: int = PAGE_ROWS) -> DataFrame:
    """`view` sorted by `key` over all files, with small row groups, page indexes and Bloom filters on the key.

    A lookup skips files and row groups by least and greatest key and by Bloom filter, and pages by the page index. `distinct`:
    keys a file may hold, which sets the size of its filters; by default counted per file on average.
    """
    sorted_ = (view.repartitionByRange(files, key) if files else view.repartitionByRange(key)).sortWithinPartitions(key)
    if distinct is None:
        rows = view.count()
        distinct = max(1000, 2 * rows // (files or int(view.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(distinct),
               "parquet.block.size": str(group_bytes), "parquet.page.row.count.limit": str(page_rows),
               "parquet.block.size.row.check.min": "1000", "parquet.page.size.row.check.min": "1000"}
    sorted_.write.options(**options).mode("overwrite").parquet(path)
    return view.sparkSession.read.schema(view.schema).parquet(path)


def _any_of(key: str, names: Sequence[str]) -> Column:
    """Key is one of the names, as filters of at most PUSHED_NAMES names, which a scan can use each."""
    ordered = sorted(set(names), key=str.encode)
    parts = [F.col(key).isin(ordered[i : i + PUSHED_NAMES]) for i in range(0, len(ordered), PUSHED_NAMES)]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def lookup(table: DataFrame, names: Sequence[str] | DataFrame, key: str = "domain", pushed: int = 1_000) -> DataFrame:
    """Rows of the named keys. A list, or a frame of up to `pushed` names, becomes filters of the scan; a longer one is joined.

    Both give the same rows; the join lets Spark choose between broadcast and shuffle by size.
    """
    if isinstance(names, DataFrame):
        asked = names.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
        few = [r[0] for r in asked.limit(pushed + 1).collect()]
        if len(few) > pushed:
            return table.join(asked, key, "left_semi")
        names = few
    return table.where(_any_of(key, [n for n in names if n is not None]))
