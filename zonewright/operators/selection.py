"""Choosing domains to scrape again and turning them into requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.operators import ranks
from zonewright.operators.names import Suffixes, rdap_unsupported, suffix_of
from zonewright.operators.reports import ago

SCRAPERS = ("dns", "rdap", "whois")
WHOIS_FIRST = ["gov", "us"]


def select_domains(current: DataFrame, *, as_of=None, modified_by: str | None = None,
                   not_modified_by: str | None = None, domain: str | None = None, domain_like: str | None = None,
                   domain_not_like: Sequence[str] = (), tld: str | None = None, ns_domain: str | None = None,
                   pm_username: str | None = None, has_pm_username: bool = False,
                   never_scraped: Sequence[str] = (), scraped_days_ago: dict[str, int] | None = None,
                   not_punycode: bool = False) -> DataFrame:
    """AND of the given filters. `domain_like` takes SQL patterns; `tld` may be ''.

    `never_scraped` and `scraped_days_ago` name scrapers (dns, rdap, whois).
    """
    conds: list[Column] = []
    name = F.col("domain")
    if modified_by:
        conds.append(F.col("modified_by") == modified_by)
    if not_modified_by:
        conds.append(F.col("modified_by") != not_modified_by)
    if domain:
        conds.append(name == domain)
    if domain_like:
        conds.append(name.like(domain_like))
    conds += [~name.like(p) for p in domain_not_like]
    if tld is not None:
        conds.append(F.col("tld") == tld)
    if pm_username:
        conds.append(F.col("pm_username") == pm_username)
    if has_pm_username:
        conds.append(F.col("pm_username").isNotNull())
    conds += [F.col(f"{s}_scraped").isNull() for s in never_scraped]
    for scraper, days in (scraped_days_ago or {}).items():
        col = f"{scraper}_scraped"
        conds.append(F.col(col) < ago(current, col, as_of, days=days))
    if not_punycode:
        conds.append(~name.contains("xn--"))
    if ns_domain:
        conds.append(F.coalesce(F.array_contains("ns_domains", ns_domain), F.lit(False)))
    for c in conds:
        current = current.where(c)
    return current


def by_capability(current: DataFrame, suffixes: Suffixes, supported: bool) -> DataFrame:
    """Names whose stored suffix has (or lacks) RDAP."""
    lacks = rdap_unsupported(suffixes).withColumnRenamed("suffix", "tld")
    if not supported:
        return current.join(lacks, "tld", "left_semi").select(*current.columns)
    return current.where(F.col("tld").isNotNull()).join(lacks, "tld", "left_anti").select(*current.columns)


def by_source(current: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Distinct names whose last writer is one of the sources."""
    return current.where(F.col("modified_by").isin(*sources)).select("domain").distinct()


def shuffled(df: DataFrame, n: int | None = None, key: str = "domain", portable: bool = False) -> DataFrame:
    """Order that looks random but is always the same: by hash of the key (`portable`: md5), then key, which must be unique.

    With `n`, the first n rows in that order: they are cut off by rank, so no task holds n rows.
    """
    drawn = df.withColumn("_drawn", F.md5(F.col(key)) if portable else F.xxhash64(key))
    if n is not None:
        drawn = ranks.first_rows(drawn, [("_drawn", True), (key, True)], n)
    return drawn.orderBy("_drawn", key).drop("_drawn")


def with_scrapers(names: DataFrame, scrapers: Sequence[str]) -> DataFrame:
    """Each name once per scraper."""
    unknown = set(scrapers) - set(SCRAPERS)
    if unknown:
        raise ValueError(f"unknown scraper {sorted(unknown)}")
    return names.select("domain", F.explode(F.array(*[F.lit(s) for s in scrapers])).alias("scraper"))


def route_requests(pairs: DataFrame, suffixes: Suffixes, shard: str | None = None) -> tuple[DataFrame, DataFrame]:
    """`(domain, scraper)` to (requests `(topic, key, value)`, rejected with reason).

    whois turns into rdap where the suffix has RDAP. With `shard` (a column) RDAP topics get that
    ending and names without a shard are dropped.
    """
    lacks = rdap_unsupported(suffixes).select(F.col("suffix").alias("_suffix"), F.lit(True).alias("_lacks"))
    tagged = suffix_of(pairs, "domain", suffixes, "_suffix").join(lacks, "_suffix", "left")
    scraper = F.when((F.col("scraper") == "whois") & F.col("_lacks").isNull(), F.lit("rdap")).otherwise(F.col("scraper"))
    routed = tagged.withColumn("scraper", scraper)
    known = F.coalesce(F.col("scraper").isin(*SCRAPERS), F.lit(False))
    rejected = routed.where(~known).select("domain", F.concat(F.lit("unknown scraper: "), F.coalesce("scraper", F.lit("")))
                                           .alias("reason"))
    topic = F.concat(F.lit("scrape."), F.col("scraper"))
    good = routed.where(known)
    if shard is not None:
        is_rdap = F.col("scraper") == "rdap"
        good = good.where(~is_rdap | F.col(shard).isNotNull())
        topic = F.when(is_rdap, F.concat(topic, F.lit("."), F.col(shard))).otherwise(topic)
    return good.select(topic.alias("topic"), F.lower("domain").alias("key"), F.lit("{}").alias("value")), rejected


def preferred_scraper(names: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Add `scraper`: whois for the suffixes that are asked that way first, rdap for the others."""
    tagged = suffix_of(names, "domain", suffixes, "_suffix")
    return tagged.withColumn("scraper", F.when(F.col("_suffix").isin(*WHOIS_FIRST), "whois").otherwise("rdap")).drop("_suffix")


def follow_ups(updates: DataFrame, suffixes: Suffixes) -> DataFrame:
    """dns and whois requests for every name a zone file update touched."""
    fresh = updates.where(F.col("modified_by") == "zonefile").select("domain")
    return route_requests(with_scrapers(fresh, ["dns", "whois"]), suffixes)[0]
