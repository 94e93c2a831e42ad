"""Small tables and set operations: lookups, upserts, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators.names import Suffixes, suffix_of
from zonewright.operators.skew import salted_join


def bulk_lookup(current: DataFrame, names: DataFrame, key: str = "domain") -> DataFrame:
    """Rows of the named keys; each key once however often it was asked for."""
    return current.join(names.select(key).distinct(), key, "left_semi")


def missing_names(names: DataFrame, current: DataFrame, key: str = "domain") -> DataFrame:
    """Asked-for keys that are not there, each once."""
    return names.select(key).distinct().join(current.select(key), key, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have: what an insert would add."""
    return source.join(target.select(key), key, "left_anti")


def copy_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target plus those rows; existing keys are left alone."""
    return target.unionByName(insert_if_absent(target, source, key).select(*target.columns))


def one_per_key(rows: DataFrame, key: str, rank: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by `rank` (source, then position in it): later sources win."""
    rest = [c for c in rows.columns if c != key and c not in rank]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*rank)).alias("_r")).select(key, "_r.*")


def union_registrars(au: DataFrame, main: DataFrame) -> DataFrame:
    """The two registrar lists `(registrar_id, registrar_name, row_no)` as one name per id.

    Names of the first list are lower-cased; an id in both takes the second list's name.
    """
    first = au.select("registrar_id", F.lower("registrar_name").alias("registrar_name"), F.lit(0).alias("rank"), "row_no")
    second = main.select("registrar_id", "registrar_name", F.lit(1).alias("rank"), "row_no")
    return one_per_key(first.unionByName(second), "registrar_id", ["rank", "row_no"])


def registrar_names(main: DataFrame, au: DataFrame) -> DataFrame:
    """Name to id for text responses: exact spelling, an AU entry wins over the main list."""
    both = main.withColumn("rank", F.lit(0)).unionByName(au.withColumn("rank", F.lit(1)))
    return one_per_key(both.select("registrar_name", "registrar_id", "rank", "row_no"), "registrar_name",
                       ["rank", "row_no"])


def upsert_dimension(target: DataFrame, source: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(merged, changed): insert new keys, update where the value is distinct; changed lists only those."""
    joined = target.select(key, F.col(value).alias("_old"), F.lit(True).alias("_had")).join(
        source.select(key, F.col(value).alias("_new"), F.lit(True).alias("_has")), key, "full_outer")
    merged = joined.select(key, F.when(F.col("_has"), F.col("_new")).otherwise(F.col("_old")).alias(value))
    changed = joined.where(F.col("_has") & (F.col("_had").isNull() | ~F.col("_new").eqNullSafe(F.col("_old")))) \
        .select(key, F.col("_new").alias(value))
    return merged, changed


def propagate_names(domains: DataFrame, changed: DataFrame, key: str = "registrar_id", value: str = "registrar_name",
                    spread: str = "domain") -> DataFrame:
    """Write changed registrar names into the rows that refer to them.

    A big registrar holds a large part of all rows, so the join is salted.
    """
    new = changed.select(key, F.col(value).alias("_new"), F.lit(True).alias("_hit"))
    joined = salted_join(domains, new, [key], F.col(spread))
    return joined.withColumn(value, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(value))).select(*domains.columns)


def shard_for_domain(df: DataFrame, bootstrap: DataFrame, suffixes: Suffixes, host: str = "domain",
                     out: str = "shard") -> DataFrame:
    """Short name of the RDAP server that answers for the name's suffix; NULL if none does."""
    servers = (bootstrap.groupBy(F.col("tld").alias("_tld")).agg(F.max("url").alias("_url"))
               .select("_tld", text.url_short_name(F.col("_url")).alias(out)))
    tagged = suffix_of(df, host, suffixes, "_tld")
    return salted_join(tagged, servers, ["_tld"], F.col(host)).drop("_tld")


def registry_status(domains: DataFrame, info: DataFrame) -> DataFrame:
    """Registry rows as `(domain, registered, registration_date)`; rows of other states are dropped."""
    asked = domains.where(F.lower("whois_check_status").isin("available", "not available"))
    joined = asked.join(info.withColumnRenamed("domain_id", "id"), "id", "left")
    day = text.plausible_registration(F.col("estimated_created_date").cast("date"))
    return joined.select("domain", text.registered_by_status(F.col("whois_check_status")).alias("registered"),
                         text.midnight(day).alias("registration_date"))


def ownership_rows(names: DataFrame, users: DataFrame) -> DataFrame:
    """Names joined to their owner: `(domain, username, blacklisted, added)`.

    One owner may hold a large part of the names: salted.
    """
    who = users.select(F.col("id").alias("owner"), F.col("nam").alias("username"))
    joined = salted_join(names, who, ["owner"], F.col("nam"), "inner")
    return joined.select(F.col("nam").alias("domain"), "username", "blacklisted", "added")


def lookup_report(rows: DataFrame, blank_host: Column | str | None = None) -> DataFrame:
    """Five fixed columns, lists comma-joined; both lists blank where the servers contain `blank_host`."""
    ns, nsd = text.list_text(F.col("ns")), text.list_text(F.col("ns_domains"))
    if blank_host is not None:
        blank = F.coalesce(ns.contains(blank_host), F.lit(False))
        ns, nsd = F.when(blank, "").otherwise(ns), F.when(blank, "").otherwise(nsd)
    return rows.select("domain", ns.alias("ns"), nsd.alias("ns_domains"), "expiration_date", "registrar_id")
