"""Batch sources: dimensions, traffic, ownership, registry status, name lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions.text import strip_space
from zonewright.operators import dims
from zonewright.operators.names import Suffixes, only_normalized, normalize

TRAFFIC_COLS = ["domain", "visits", "lastdate", "hits", "geo", "visits_arr", "rank"]


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Seven columns of the traffic files; the projection reaches the Parquet scan."""
    return spark.read.parquet(path).select(*TRAFFIC_COLS)


def traffic_updates(traffic: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Traffic rows of registrable names as typed updates."""
    t = only_normalized(traffic, "domain", suffixes)
    return t.select(F.lower("domain").alias("domain"), F.lit("PIResult").alias("type"), F.lit("pi").alias("modified_by"),
                    F.col("visits").cast("bigint").alias("visits_12m"), F.col("hits").cast("bigint").alias("hits_12m"),
                    F.col("visits_arr").cast("array<bigint>").alias("visits_arr_12m"),
                    F.col("lastdate").cast("date").alias("last_visit_date"), F.col("geo").alias("hits_geo"),
                    F.col("rank").cast("bigint").alias("pi_rank"))


def ownership_updates(owned: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Rows `(domain, username, blacklisted, added)` of registrable names as typed updates."""
    t = only_normalized(owned, "domain", suffixes)
    return t.select(F.lower("domain").alias("domain"), F.lit("OwnershipResult").alias("type"),
                    F.lit("ownership").alias("modified_by"), F.col("username").alias("pm_username"),
                    F.col("blacklisted").alias("pm_blacklisted"), F.col("added").alias("pm_added"))


def read_jdbc(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    """A JDBC table. Give partitionColumn, lowerBound, upperBound and numPartitions in the options for
    a parallel read; filters and column choice on the frame are pushed to the database."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def read_ownership(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    names = read_jdbc(spark, options, "dmn_name").select("nam", "owner", "blacklisted", "added")
    return dims.ownership_rows(names, read_jdbc(spark, options, "usr").select("id", "nam"))


def read_registry_status(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    domains = read_jdbc(spark, options, "domains").select("id", "domain", "whois_check_status")
    info = read_jdbc(spark, options, "domains_info").select("domain_id", "estimated_created_date")
    return dims.registry_status(domains, info)


def status_requests(domains: DataFrame) -> DataFrame:
    """DNS requests for the names a registry table lists as taken."""
    taken = domains.where(F.col("whois_check_status") == "Not Available")
    return taken.select(F.lit("scrape.dns").alias("topic"), F.lower("domain").alias("key"), F.lit("{}").alias("value"))


def read_status_requests(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return status_requests(read_jdbc(spark, options, "domains").select("domain", "whois_check_status"))


def _registrar_csv(spark: SparkSession, path: str, id_col: str) -> DataFrame:
    """CSV with a header, read by name; `row_no` orders the lines of a file."""
    rows = spark.read.csv(path, header=True)
    return rows.select(F.col(id_col).cast("bigint").alias("registrar_id"), "registrar_name",
                       F.monotonically_increasing_id().alias("row_no"))


def read_registrars(spark: SparkSession, csv_au: str, csv_main: str) -> tuple[DataFrame, DataFrame]:
    """(AU list, main list), each `(registrar_id, registrar_name, row_no)`; their id columns differ."""
    return _registrar_csv(spark, csv_au, "registrar_id"), _registrar_csv(spark, csv_main, "id")


def clean_names(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.select(F.lower(strip_space(F.col(line))).alias("domain"))


def read_domain_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, stripped and lower-cased."""
    return clean_names(spark.read.text(path))


def import_names(names: DataFrame, suffixes: Suffixes) -> tuple[DataFrame, DataFrame]:
    """Uploaded names to (minimal updates, one row of valid and invalid counts)."""
    named = normalize(names, "domain", suffixes, "_norm")
    updates = named.where(F.col("_norm").isNotNull()).select(
        F.col("_norm").alias("domain"), F.lit("Result").alias("type"), F.lit("csv_import").alias("modified_by"))
    counts = named.agg(F.count_if(F.col("_norm").isNotNull()).alias("valid"),
                       F.count_if(F.col("_norm").isNull()).alias("invalid"))
    return updates, counts


def suffix_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Suffix list text without blank and comment lines; rules stay as written."""
    cut = F.regexp_replace(line, r"(?U)\s+$", "")
    return lines.select(cut.alias("suffix")).where((F.col("suffix") != "") & ~F.col("suffix").startswith("//"))


def read_suffixes(spark: SparkSession, path: str) -> Suffixes:
    return Suffixes.from_table(suffix_lines(spark.read.text(path)))


def bootstrap_rows(docs: DataFrame, body: str = "value") -> DataFrame:
    """RDAP bootstrap JSON (`services: [[suffixes, urls], ...]`) to `(tld, url)`, first URL of each."""
    services = F.from_json(body, "struct<services:array<array<array<string>>>>")["services"]
    each = docs.select(F.explode(services).alias("s"))
    return each.select(F.explode(F.col("s")[0]).alias("tld"), F.get(F.get("s", F.lit(1)), F.lit(0)).alias("url"))


def read_rdap_bootstrap(spark: SparkSession, path: str) -> DataFrame:
    return bootstrap_rows(spark.read.text(path, wholetext=True))


def read_whois_servers(spark: SparkSession, path: str) -> DataFrame:
    """`(tld, whois_server)`; incomplete entries dropped."""
    rows = spark.read.schema("tld string, whois_server string").json(path, multiLine=True)
    return rows.where((F.coalesce("tld", F.lit("")) != "") & (F.coalesce("whois_server", F.lit("")) != ""))
