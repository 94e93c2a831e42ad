"""Registered queries over stored layouts: keyed state, bucketed and indexed tables, ranges, fingerprints, ranks, intervals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators import enrich, fingerprints, heavy, history, interning, intervals, merge, ranks, search, selection, sketches, snapshots, trigrams
from zonewright.plans import catalog_search, catalog_sources, catalog_updates, shaped
from zonewright.plans.catalog_updates import _FOLDED, _NX_MESSAGES, _REASON, _run_dir, event_messages
from zonewright.plans.shaped import EVENT_LOG_SQL, LOG_SQL, SERVERS_SQL, current, current_with_servers, domain_log, event_log, event_updates, table
from zonewright.sources import keyed_tables, messages

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


# --- keyed state ---------------------------------------------------------------------------------
@query("stream_current_rows", f"""WITH {_NX_MESSAGES}, j AS (SELECT *, 'u' || user_id || '.com' AS domain, {_REASON} AS reason FROM msgs),
  g AS (SELECT * FROM j WHERE reason IS NULL)
  SELECT domain, count(*) AS versions, 'com' AS tld, arg_max(k, seq) FILTER (event_type = 'view') AS visits_12m,
    coalesce('ns1.example.net,ns' || (arg_max(k, seq) FILTER (event_type = 'click')) || '.example.net', '') AS ns,
    CASE WHEN bool_or(event_type = 'signup') THEN false END AS registered,
    arg_max(CASE event_type WHEN 'view' THEN 'pi' WHEN 'click' THEN 'zonefile' WHEN 'signup' THEN 'rdap' ELSE 'ownership' END, seq) AS modified_by
  FROM g GROUP BY domain""")
def _(spark, sf):
    """All messages in two runs of one query with its checkpoint; rows from the state, versions counted in the log."""
    from zonewright.streaming import keyed
    from zonewright.streaming.store import VersionStore
    own, root = keyed.state_session(spark), _run_dir(spark)
    sent = event_messages(own, sf).select(F.lit("results").alias("topic"), "key", "value", F.col("seq").alias("offset"), F.col("arrived").alias("timestamp"))
    middle = ranks.row_at(sent, [("offset", True)], (sent.count() + 1) // 2)
    store = VersionStore(own, f"{root}/store")
    for part in (sent.where(F.col("offset") <= (middle[0] if middle else 0)), sent.where(F.col("offset") > (middle[0] if middle else 0))):
        part.write.mode("append").parquet(f"{root}/in")
        source = messages.read_stream(own, "parquet", {}, f"{root}/in")
        for running in keyed.stream_versions(source, store, f"{root}/checkpoint", shaped.suffixes(own), trigger={"availableNow": True}):
            running.awaitTermination()
    keyed.current_rows(own, f"{root}/checkpoint").write.parquet(f"{root}/rows")
    counts = spark.read.parquet(f"{root}/store/log").groupBy("domain").agg(F.count(F.lit(1)).alias("versions"))
    return (spark.read.parquet(f"{root}/rows").join(counts, "domain", "full_outer")
            .select("domain", "versions", "tld", "visits_12m", F.array_join("ns", ",").alias("ns"), "registered", "modified_by"))


# --- tables laid out by key ------------------------------------------------------------------------
@query("merge_into_bucketed", catalog_updates.ORACLES["merge_updates"])
def _(spark, sf):
    name = f"zonewright_current_{uuid.uuid4().hex}"
    stored = keyed_tables.write_bucketed(catalog_updates._stored(spark, sf), name, f"{_run_dir(spark)}/current", rows_per_bucket=500)
    return merge.merge_updates(stored, event_updates(spark, sf), cols=_FOLDED)


@query("lookup_names", f"""WITH {LOG_SQL} SELECT domain, tld, registered, visits_12m FROM cur
  WHERE domain IN (SELECT {shaped.CUSTOMER_DOMAIN_SQL} FROM customer WHERE c_acctbal > 9000)""")
def _(spark, sf):
    asked = table(spark, sf, "customer").where(F.col("c_acctbal") > 9000).select(shaped.customer_domain().alias("domain"))
    view = current(spark, sf, "tld", "registered", "visits_12m")
    return keyed_tables.lookup(keyed_tables.write_lookup(view, f"{_run_dir(spark)}/names"), asked)


# --- address ranges ----------------------------------------------------------------------------------
@query("geo_lookup_ranges", catalog_sources.ORACLES["geo_lookup"])
def _(spark, sf):
    a = catalog_sources.dns_answers(spark, sf).where(F.col("rrtype") == "A")
    rows = a.groupBy(F.lower("domain").alias("domain")).agg(F.collect_set("rdata").alias("addr"))
    found = enrich.lookup_lists(rows, ["domain"], {"geo": (catalog_sources.networks(spark, sf), "country_code")}, find=intervals.range_lookup)
    return found.withColumn("geo", text.list_text(F.col("geo")))


# --- fingerprints of snapshots -------------------------------------------------------------------------
@query("diff_stored_snapshots", catalog_updates.ORACLES["diff_snapshots"])
def _(spark, sf):
    root = _run_dir(spark)
    for name, snap in zip(("prev", "cur"), catalog_updates._two_days(spark, sf)):
        fingerprints.write_snapshot(snap, f"{root}/{name}")
    return fingerprints.diff_stored(spark, f"{root}/prev", f"{root}/cur").withColumn("ns", F.array_join("ns", ","))


# --- dictionary of lists -----------------------------------------------------------------------------
def _stored_days(spark, sf, root):
    """Both days as an import finds them: stored, so that whoever reads a day twice does not build it again."""
    snap = snapshots.zone_snapshot(catalog_updates.zone_records(spark, sf), ["date"])
    snap.write.parquet(f"{root}/days")
    days = spark.read.schema(snap.schema).parquet(f"{root}/days")
    return [days.where(F.col("date") == F.lit(d).cast("date")).drop("date") for d in ("2024-03-01", "2024-03-03")]


@query("diff_interned_snapshots", catalog_updates.ORACLES["diff_snapshots"])
def _(spark, sf):
    """Two imports into one dictionary; what is compared are the stored ids."""
    root = _run_dir(spark)
    lists = interning.ListDictionary(spark, f"{root}/dictionary")
    for name, snap in zip(("prev", "cur"), _stored_days(spark, sf, root)):
        lists.add(snap)
        lists.encode(snap).write.parquet(f"{root}/{name}")
    prev, cur = (spark.read.schema("domain string, ns_hash bigint, ns_no int").parquet(f"{root}/{n}") for n in ("prev", "cur"))
    return interning.diff_encoded(prev, cur, lists).withColumn("ns", F.array_join("ns", ","))


@query("interned_lists", f"WITH {catalog_updates.ZONE_SQL} SELECT array_to_string(ns, ',') AS ns, count(*) AS rows, min(date) AS first_day FROM snap GROUP BY 1")
def _(spark, sf):
    """Lists as the dictionary holds them, once each, with the import that brought them and the rows of both days that have their id."""
    root = _run_dir(spark)
    lists = interning.ListDictionary(spark, f"{root}/dictionary")
    days, parts = ("2024-03-01", "2024-03-03"), []
    for day, snap in zip(days, _stored_days(spark, sf, root)):
        lists.add(snap)
        parts.append(lists.encode(snap).select("ns_hash", "ns_no", F.lit(day).cast("date").alias("day")))
    uses = parts[0].unionByName(parts[1]).groupBy("ns_hash", "ns_no").agg(F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"))
    return lists.decode(uses).select(F.array_join("ns", ",").alias("ns"), "rows", "first_day")


# --- ranks -----------------------------------------------------------------------------------------
@query("search_page_deep", f"""WITH {LOG_SQL} SELECT domain, pm_username, last_modified FROM cur
  ORDER BY last_modified DESC NULLS LAST, domain LIMIT 40 OFFSET 130""")
def _(spark, sf):
    view = current(spark, sf, "pm_username", "last_modified")
    return search.deep_page(view, search.Page("last_modified", "desc", 40, 130), small=50)


@query("page_after_nulls", f"""WITH {LOG_SQL} SELECT domain, pm_username FROM cur ORDER BY pm_username ASC NULLS LAST, domain
  LIMIT 25 OFFSET (SELECT count(*) FILTER (pm_username IS NOT NULL) + 1 FROM cur)""")
def _(spark, sf):
    """A page that lies among the rows without a value."""
    view = current(spark, sf, "pm_username")
    offset = view.where(F.col("pm_username").isNotNull()).count() + 1
    return search.deep_page(view, search.Page("pm_username", "asc", 25, offset), small=20)


@query("shuffle_select_many", f"WITH {LOG_SQL} SELECT domain FROM cur ORDER BY md5(domain), domain LIMIT (SELECT count(*) // 2 FROM cur)")
def _(spark, sf):
    view = current(spark, sf, "seq").select("domain")
    return selection.shuffled(view, view.count() // 2, portable=True)


# --- validity ----------------------------------------------------------------------------------------
@query("table_as_of_day", f"""WITH {LOG_SQL} SELECT domain, tld, registered, visits_12m, last_modified FROM log WHERE last_modified < TIMESTAMP '1998-07-01'
  QUALIFY row_number() OVER (PARTITION BY domain ORDER BY last_modified DESC, seq DESC) = 1""")
def _(spark, sf):
    path = f"{_run_dir(spark)}/validity"
    log = domain_log(spark, sf).select("seq", "domain", "tld", "registered", "visits_12m", "last_modified")
    history.write_validity(history.validity(log), path)
    return history.as_of_day(spark.read.parquet(path), "1998-06-30").drop("seq")


@query("validity_intervals", f"""WITH {LOG_SQL} SELECT seq, domain, last_modified AS valid_from,
  lead(last_modified) OVER (PARTITION BY domain ORDER BY last_modified, seq) AS valid_to FROM log""")
def _(spark, sf):
    return history.validity(domain_log(spark, sf).select("seq", "domain", "last_modified")).drop("last_modified")


# --- summaries and indexes -----------------------------------------------------------------------------
@query("facet_by_summaries", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT label, count(*) AS count
  FROM (SELECT unnest(ns_domains) AS label FROM curns) GROUP BY label ORDER BY count DESC, label LIMIT 100""")
def _(spark, sf):
    return heavy.facet(current_with_servers(spark, sf), "ns_domains", capacity=512)


@query("facet_by_certified_summaries", f"""WITH {LOG_SQL}
  SELECT CASE WHEN seq % 3 = 0 THEN modified_by ELSE domain END AS label, count(*) AS count FROM log GROUP BY label ORDER BY count DESC, label LIMIT 5""")
def _(spark, sf):
    """A few frequent values among very many rare ones."""
    log = domain_log(spark, sf)
    return heavy.facet(log.select(F.when(F.col("seq") % 3 == 0, F.col("modified_by")).otherwise(F.col("domain")).alias("v")), "v", size=5, capacity=400)


@query("search_substring_indexed", catalog_search.ORACLES["search_array_substring"])
def _(spark, sf):
    cur, path = current_with_servers(spark, sf), f"{_run_dir(spark)}/index"
    trigrams.write_index(cur, "ns", path)
    found = trigrams.search_keys(spark, path, "-00000001").withColumnRenamed("key", "domain")
    return cur.join(found, "domain", "left_semi").select("domain", text.list_text(F.col("ns")).alias("ns"))


@query("names_of_spans", f"""WITH {EVENT_LOG_SQL}, s AS (SELECT DATE '2024-01-01' + CAST(a AS INTEGER) AS first, DATE '2024-01-01' + CAST(a + b AS INTEGER) AS last
    FROM range(0, 40, 6) x(a), range(0, 12, 5) y(b))
  SELECT first, last, count(DISTINCT domain) AS exact, true AS within FROM s LEFT JOIN elog ON CAST(last_modified AS DATE) BETWEEN first AND last GROUP BY first, last""")
def _(spark, sf):
    """Spans of days answered from stored sketches, held against exact counts: within four standard errors."""
    path, log = f"{_run_dir(spark)}/sketches", event_log(spark, sf).select("domain", "last_modified")
    sketches.daily_sketches(log).write.parquet(path)
    spans = spark.range(0, 40, 6).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("first"), F.explode(F.array(*map(F.lit, (0, 5, 10)))).alias("_b"))
    spans = spans.select("first", F.date_add("first", F.col("_b")).alias("last"))
    found = sketches.names_in_spans(spark.read.parquet(path), spans)
    days = log.select("domain", F.to_date("last_modified").alias("day")).distinct()
    exact = spans.withColumn("day", F.explode(F.sequence("first", "last"))).join(days, "day", "left").groupBy("first", "last").agg(F.countDistinct("domain").alias("exact"))
    error = 4 / 2 ** (sketches.LG / 2)
    return found.join(exact, ["first", "last"]).select("first", "last", "exact", (F.abs(F.col("names") - F.col("exact")) <= F.col("exact") * F.lit(error)).alias("within"))
