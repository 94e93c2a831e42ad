"""Public-suffix matching and everything that rests on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.operators.skew import salted_join

# fixed values: suffixes whose registries offer no RDAP (every listed suffix under .au joins them)
RDAP_UNSUPPORTED = ["au", "be", "cm", "cn", "co", "co.ke", "co.kr", "co.za", "com.vn", "de", "eu", "gr", "hu",
                    "in", "io", "it", "ru", "us"]


def _local_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """From an Arrow table: Spark then knows its size before it plans a join with it."""
    return spark.createDataFrame(pa.table({"suffix": list(dict.fromkeys(names))}))


@dataclass(frozen=True)
class Suffixes:
    """Suffix dimension: `table(suffix)` and the largest number of labels in it."""

    table: DataFrame
    max_labels: int

    @staticmethod
    def of(spark: SparkSession, names: Sequence[str]) -> Suffixes:
        return Suffixes(_local_table(spark, names), max(n.count(".") + 1 for n in names))

    @staticmethod
    def from_table(table: DataFrame) -> Suffixes:
        """From a one-column frame; rules are taken literally, repeats dropped."""
        table = table.select("suffix").distinct()
        widest = table.agg(F.max(F.size(F.split("suffix", r"\."))).alias("n")).first()["n"]
        return Suffixes(table, int(widest or 1))


def _tail(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _label_count(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def suffix_of(df: DataFrame, host: str, suffixes: Suffixes, out: str = "suffix") -> DataFrame:
    """Longest listed suffix that follows a dot in the host; NULL if none (a bare suffix has none).

    One left join per label count against the suffix table. Spark broadcasts the table when its
    size is under the session's limit, so there is no shuffle; a larger one is joined by shuffle.
    """
    found = []
    for n in range(suffixes.max_labels, 0, -1):
        hit = suffixes.table.select(F.col("suffix").alias(f"_s{n}"))
        df = df.join(hit, F.when(_label_count(F.col(host)) > n, _tail(F.col(host), n)) == F.col(f"_s{n}"), "left")
        found.append(f"_s{n}")
    return df.withColumn(out, F.coalesce(*found)).drop(*found)


def registrable(host: Column, suffix: Column) -> Column:
    """Suffix plus one label; NULL where there is no suffix."""
    labels = F.split(host, r"\.")
    keep = _label_count(suffix) + 1
    return F.when(suffix.isNotNull(), F.array_join(F.slice(labels, F.greatest(F.size(labels) - keep + 1, F.lit(1)),
                                                           keep), "."))


def normalize(df: DataFrame, host: str, suffixes: Suffixes, out: str = "normalized") -> DataFrame:
    matched = suffix_of(df, host, suffixes, "_suffix")
    return matched.withColumn(out, registrable(F.col(host), F.col("_suffix"))).drop("_suffix")


def only_normalized(df: DataFrame, host: str, suffixes: Suffixes) -> DataFrame:
    """Rows whose name already is a registrable name."""
    return normalize(df, host, suffixes, "_norm").where(F.col("_norm") == F.col(host)).drop("_norm")


def normalize_list(df: DataFrame, hosts: str, suffixes: Suffixes, key: Sequence[str],
                   out: str = "ns_domains") -> DataFrame:
    """Per key the sorted distinct registrable names of a host list, [] for none.

    `key` must identify a row; other columns are not carried. Suffixes are matched where the hosts stand: the rows of
    a list are still together, so its names are gathered before the shuffle, which moves one row per list and none per host.
    """
    each = df.select(*key, F.explode_outer(hosts).alias("_host"))
    return normalize(each, "_host", suffixes, "_name").groupBy(*key).agg(F.array_sort(F.collect_set("_name")).alias(out))


def replace_list(new: Column, old: Column) -> Column:
    """Take the rewritten list only when it holds something and differs."""
    return F.when((F.size(new) > 0) & ~new.eqNullSafe(old), new).otherwise(old)


def normalise_ns_domains(domains: DataFrame, suffixes: Suffixes, col: str = "ns_domains",
                         key: str = "domain") -> DataFrame:
    """Rewrite a list column to registrable names in all rows.

    Work is done once per distinct list: there are far fewer lists than rows, since hosting
    companies put the same servers on all their names. The way back to the rows is salted, as one
    list may be that of a large part of all rows.
    """
    lists = domains.select(F.array_sort(col).alias("_list")).distinct()
    changed = (normalize_list(lists.where(F.size("_list") > 0), "_list", suffixes, ["_list"], "_new")
               .where(~F.col("_new").eqNullSafe(F.col("_list"))))
    tagged = domains.withColumn("_list", F.array_sort(col))
    joined = salted_join(tagged, changed, ["_list"], F.col(key))
    # a list that maps to itself is not in `changed`: its rows only get the sorted form
    rewritten = F.coalesce("_new", "_list")
    return joined.withColumn(col, replace_list(rewritten, F.col(col))).select(*domains.columns)


def rdap_unsupported(suffixes: Suffixes) -> DataFrame:
    """Suffixes to ask by WHOIS only."""
    fixed = _local_table(suffixes.table.sparkSession, RDAP_UNSUPPORTED)
    return fixed.unionByName(suffixes.table.where(F.col("suffix").endswith(".au"))).distinct()


def audit_tlds(domains: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Names whose stored suffix is set but differs from the computed one; NULL stored shows as ''."""
    computed = suffix_of(domains.select("domain", "tld").where((F.col("domain") != "")), "domain", suffixes, "_tld")
    wrong = ~F.col("tld").eqNullSafe(F.col("_tld")) & F.col("_tld").isNotNull() & ~F.col("tld").eqNullSafe(F.lit(""))
    return computed.where(wrong).select("domain", F.coalesce("tld", F.lit("")).alias("in_db_tld"),
                                        F.col("_tld").alias("python_tld_method"))


def repair_tlds(domains: DataFrame, audit: DataFrame) -> DataFrame:
    """Domains with the audited suffix written back."""
    fixes = audit.groupBy("domain").agg(F.max("python_tld_method").alias("_fix"))
    return (domains.join(fixes, "domain", "left").withColumn("tld", F.coalesce("_fix", "tld"))
            .select(*domains.columns))


def unicode_tlds(df: DataFrame, col: str = "tld", out: str = "tld") -> DataFrame:
    """IDNA form to Unicode, decoded once per distinct suffix; anything undecodable is kept."""

    @F.pandas_udf("string")
    def decode(names: pd.Series) -> pd.Series:
        def one(name: str | None) -> str | None:
            try:
                return name if name is None else name.encode().decode("idna")
            except UnicodeError:
                return name
        return names.map(one)

    table = (df.select(F.col(col).alias("_from")).where(F.col(col).startswith("xn--") | F.col(col).contains(".xn--"))
             .distinct().withColumn("_to", decode("_from")))
    # the key is set for such names only: all others, a hot suffix among them, have none and are joined with nothing
    joined = df.join(table, F.when(F.col(col).contains("xn--"), F.col(col)) == F.col("_from"), "left")
    return joined.withColumn(out, F.coalesce("_to", F.col(col))).drop("_from", "_to")
