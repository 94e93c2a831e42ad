"""Maintenance jobs: compositions of the operators over the big table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators import dims, ranks, selection
from zonewright.operators.names import Suffixes, normalize_list, unicode_tlds
from zonewright.operators.search import search, snapshot
from zonewright.operators.snapshots import diff_snapshots, zone_snapshot
from zonewright.sources import zone
from zonewright.sources.messages import write_messages


def zone_updates(changes: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Zone changes `(tld, date, domain, ns)` to typed updates, stamped with midnight of the day."""
    # the list itself is part of the key, so nothing has to be joined back
    rows = unicode_tlds(normalize_list(changes, "ns", suffixes, ["tld", "date", "domain", "ns"], "ns_domains"))
    cols = ["ns", "ns_domains", "tld", "zonefile_date", "modified_by", "last_modified"]
    return rows.select("domain", F.lit("ZonefileResult").alias("type"), F.array(*[F.lit(c) for c in cols]).alias("fields"),
                       "ns", "ns_domains", "tld", F.col("date").alias("zonefile_date"),
                       F.lit("zonefile").alias("modified_by"), text.midnight(F.col("date")).alias("last_modified"))


def zone_changes(records: DataFrame, plan: DataFrame) -> DataFrame:
    """Changes of every planned import at once: `(tld, date, domain, ns)`.

    `records(tld, date, domain, ns)` come from all files needed; `plan(tld, date, prev_date)` says
    what each import is compared with. A NULL prev_date means all rows and no removals. A snapshot
    that is the current one of one day and the previous one of the next is built once.
    """
    snaps = zone_snapshot(records, ["tld", "date"])
    cur = snaps.join(plan.select("tld", "date"), ["tld", "date"], "left_semi")
    before = plan.where(F.col("prev_date").isNotNull()).select("tld", F.col("date").alias("_for"),
                                                               F.col("prev_date").alias("date"))
    prev = snaps.join(before, ["tld", "date"]).select("tld", F.col("_for").alias("date"), "domain", "ns")
    return diff_snapshots(prev, cur, ["tld", "date"])


def import_zones(spark: SparkSession, folder: str, ledger: DataFrame, suffixes: Suffixes, *, full: bool = False,
                 tlds: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(updates, imports done) for all files not yet imported; write both, the ledger last."""
    files, _ = zone.list_zone_files(spark, folder)
    plan = zone.pending_imports(zone.previous_zone_file(files), ledger, tlds, exclude)
    if full:
        plan = plan.withColumn("prev_date", F.lit(None).cast("date")).withColumn("prev_path", F.lit(None).cast("string"))
    # one line per file: the list of paths is what any reader of many files hands to Spark
    jobs = plan.select("path", "prev_path").collect()
    paths = sorted({p for r in jobs for p in (r["path"], r["prev_path"]) if p})
    if not paths:
        none = spark.createDataFrame([], "tld string, date date, domain string, ns array<string>")
        return zone_updates(none, suffixes), plan.select("tld", "date")
    changes = zone_changes(zone.read_zone(spark, paths), plan)
    return zone_updates(changes, suffixes), plan.select("tld", "date")


def queue_scrapes(names: DataFrame, scrapers: Sequence[str], suffixes: Suffixes, *, limit: int | None = None,
                  shuffle: bool = False) -> DataFrame:
    """Requests for the selected names, which are unique: exactly `limit` names if given, the first by name or in hash order."""
    picked = names.select("domain")
    if shuffle:
        picked = selection.shuffled(picked, limit)
    elif limit is not None:
        picked = ranks.first_rows(picked, [("domain", True)], limit)
    return selection.route_requests(selection.with_scrapers(picked, scrapers), suffixes)[0]


def queue_failed(errors: DataFrame, suffixes: Suffixes, as_of) -> DataFrame:
    from zonewright.operators.reports import failed_scrapes
    return selection.route_requests(failed_scrapes(errors, as_of), suffixes)[0]


def queue_new(current: DataFrame, suffixes: Suffixes, sources: Sequence[str] = ("pi", "zonefile")) -> DataFrame:
    """dns for every name these sources wrote last, and whois or rdap by suffix."""
    names = selection.by_source(current, sources)
    dns = names.select(F.lit("scrape.dns").alias("topic"), F.lower("domain").alias("key"), F.lit("{}").alias("value"))
    second = selection.preferred_scraper(names, suffixes)
    return dns.unionByName(selection.route_requests(second.select("domain", "scraper"), suffixes)[0])


def queue_rdap_by_shard(current: DataFrame, bootstrap: DataFrame, suffixes: Suffixes,
                        sources: Sequence[str] = ("dns",)) -> DataFrame:
    """One rdap request per name on the topic of its server; names no server answers for are dropped."""
    names = dims.shard_for_domain(selection.by_source(current, sources), bootstrap, suffixes)
    pairs = names.withColumn("scraper", F.lit("rdap"))
    return selection.route_requests(pairs, suffixes, shard="shard")[0].orderBy("key")


def load_registry_status(current: DataFrame, domains: DataFrame, info: DataFrame) -> DataFrame:
    """Registry rows of names the table does not have yet."""
    return dims.insert_if_absent(current, dims.registry_status(domains, info), "domain")


def refresh_registrars(dimension: DataFrame, au: DataFrame, main: DataFrame,
                       domains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new dimension, domains with changed names written in)."""
    merged, changed = dims.upsert_dimension(dimension, dims.union_registrars(au, main), "registrar_id", "registrar_name")
    return merged, dims.propagate_names(domains, changed)


def refresh_search(current: DataFrame, criteria: Sequence[tuple[str, str, str]], new_id: int) -> DataFrame:
    """The same search over today's view, under a new snapshot id."""
    return snapshot(search(current, criteria), new_id)


def send_requests(requests: DataFrame, fmt: str, options: dict[str, str], path: str | None = None) -> None:
    write_messages(requests, fmt, options, path)
