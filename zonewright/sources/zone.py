"""Zone files: text lines to `(domain, ns)` records, file listing, import planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions.text import words
from zonewright.operators.once import once
from zonewright.operators.skew import spread_scan

FILE_NAME = r"zone-([a-z0-9.\-]+)-(\d{4}-\d{2}-\d{2})\.gz"
FIRST_IMPORT = "2024-02-17"  # imports of a suffix seen for the first time start after this day
LOOK_BACK = 6


def _absolute(name: Column, tld: Column) -> Column:
    """A trailing dot marks a full name; without one the suffix is to be added."""
    return F.when(name.endswith("."), F.rtrim(name, F.lit("."))).otherwise(F.concat_ws(".", name, tld))


def parse_zone_lines(lines: DataFrame, line: str = "value", tld: str = "tld", keep: Sequence[str] = ()) -> DataFrame:
    """Nameserver records of zone text: `(keep..., domain, ns)`.

    A line is owner ... type value. Short lines, the suffix's own record, other types and DNSSEC
    signatures are skipped.
    """
    split = once(lines.select(*keep, F.col(tld).alias("_tld"), F.col(line).alias("_line")), _p=words(F.lower("_line")))
    split = split.where(F.size("_p") >= 3).select(*keep, "_tld", F.col("_p")[0].alias("_owner"),
                                                  F.element_at("_p", -2).alias("_type"), F.element_at("_p", -1).alias("_value"))
    ns = split.where((F.col("_type") == "ns") & (F.col("_value") != "rrsig") &
                     (F.col("_owner") != F.concat(F.col("_tld"), F.lit("."))))
    return ns.select(*keep, _absolute(F.col("_owner"), F.col("_tld")).alias("domain"),
                     _absolute(F.col("_value"), F.col("_tld")).alias("ns"))


def read_zone(spark: SparkSession, path: str | Sequence[str], tld: str | None = None) -> DataFrame:
    """Records `(tld, date, domain, ns)` of one or many zone files, suffix and day from the file names.

    A gz file is one split, so where there are fewer files than cores the lines are dealt out before
    they are parsed. With `tld` given, file names need not follow the pattern and `date` is NULL.
    """
    paths = [path] if isinstance(path, str) else list(path)
    file = F.col("_metadata.file_name")
    lines = spark.read.text(paths)
    if tld is None:
        lines = lines.select("value", F.regexp_extract(file, FILE_NAME, 1).alias("tld"),
                             F.regexp_extract(file, FILE_NAME, 2).try_cast("date").alias("date"))
    else:
        lines = lines.select("value", F.lit(tld).alias("tld"), F.lit(None).cast("date").alias("date"))
    lines = spread_scan(lines)
    return parse_zone_lines(lines.withColumnRenamed("tld", "_zone").withColumn("tld", F.col("_zone")), keep=["_zone", "date"]) \
        .withColumnRenamed("_zone", "tld")


def zone_files(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths `(path)` to (zone files `(tld, date, path)`, names that do not fit the pattern)."""
    name = F.element_at(F.split("path", "/"), -1)
    tagged = paths.select("path", F.regexp_extract(name, "^" + FILE_NAME, 1).alias("tld"),
                          F.regexp_extract(name, "^" + FILE_NAME, 2).try_cast("date").alias("date"))
    fits = (F.col("tld") != "") & F.col("date").isNotNull()
    return tagged.where(fits).select("tld", "date", "path"), tagged.where(~fits).select("path")


def list_zone_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Zone files in a folder, contents unread."""
    return zone_files(spark.read.format("binaryFile").load(folder).select("path"))


def previous_zone_file(files: DataFrame) -> DataFrame:
    """Each file with the newest file of its suffix dated 1 to 6 days before: `(tld, date, path, prev_date, prev_path)`.

    An equi-join: each file offers itself to the six days after it.
    """
    offers = files.select("tld", F.col("date").alias("prev_date"), F.col("path").alias("prev_path"),
                          F.explode(F.sequence(F.lit(1), F.lit(LOOK_BACK))).alias("_d"))
    best = (offers.select("tld", F.date_add("prev_date", F.col("_d")).alias("date"), "prev_date", "prev_path")
            .groupBy("tld", "date").agg(F.max(F.struct("prev_date", "prev_path")).alias("_p")))
    return files.join(best, ["tld", "date"], "left").select("tld", "date", "path", "_p.prev_date", "_p.prev_path")


def last_imported(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("tld").agg(F.max("date").alias("date"))


def pending_imports(files: DataFrame, ledger: DataFrame, tlds: Sequence[str] | None = None,
                    exclude: Sequence[str] = (), default: str = FIRST_IMPORT) -> DataFrame:
    """Files newer than the last import of their suffix, oldest first."""
    wanted = files if tlds is None else files.where(F.col("tld").isin(*tlds))
    if exclude:
        wanted = wanted.where(~F.col("tld").isin(*exclude))
    done = last_imported(ledger).withColumnRenamed("date", "_last")
    return (wanted.join(done, "tld", "left").where(F.col("date") > F.coalesce("_last", F.lit(default).cast("date")))
            .drop("_last").orderBy("tld", "date"))


def record_import(done: DataFrame, path: str) -> None:
    """Append `(tld, date)` to the ledger."""
    done.select("tld", "date").write.mode("append").parquet(path)
