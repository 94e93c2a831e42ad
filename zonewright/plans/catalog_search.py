"""Registered queries: current view, search, facets, exports. Each with its SQL counterpart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions import criteria as cr
from zonewright.functions import text
from zonewright.operators import dims, latest, search, selection
from zonewright.operators.names import Suffixes
from zonewright.plans import jobs, shaped
from zonewright.plans.shaped import AS_OF_ORDERS, LOG_SQL, SERVERS_SQL, current, current_with_servers, domain_log, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


_FLAT = "domain, tld, registered, modified_by, last_modified, visits_12m, registrar_id, pm_username"
_FLAT_COLS = _FLAT.split(", ")


@query("latest_by_key", f"WITH {LOG_SQL} SELECT {_FLAT} FROM cur")
def _(spark, sf):
    return current(spark, sf, *_FLAT_COLS[1:])


@query("total_domains", f"WITH {LOG_SQL} SELECT count(DISTINCT domain) AS count FROM log")
def _(spark, sf):
    return latest.total_rows(domain_log(spark, sf))


@query("point_lookup", f"WITH {LOG_SQL} SELECT {_FLAT} FROM cur WHERE domain LIKE 'customer-000000007.%'")
def _(spark, sf):
    log = domain_log(spark, sf).select(*_FLAT_COLS, "seq")
    rows = [latest.point_lookup(log, f"customer-000000007.{t}") for t in shaped._TLD.values()]
    return reduce(DataFrame.unionByName, rows).select(*_FLAT_COLS)


@query("columns_in_schema_order", f"""WITH {LOG_SQL} SELECT domain, tld, registrar_id, visits_12m, last_modified,
  modified_by, dns_scraped, pm_username, array_to_string(status, ',') AS status, registered FROM cur""")
def _(spark, sf):
    cur = latest.in_schema_order(current(spark, sf)).drop("visits_arr_12m")
    return cur.withColumn("status", text.list_text(F.col("status")))


@query("column_group_traffic", f"WITH {LOG_SQL} SELECT domain, visits_12m FROM cur")
def _(spark, sf):
    return latest.column_group(current(spark, sf, "visits_12m", "registered"), "traffic")


def _found(spark, sf, *criteria):
    return search.search(current(spark, sf, *_FLAT_COLS[1:], "status"), criteria).select(*_FLAT_COLS)


def _search_sql(where: str) -> str:
    return f"WITH {LOG_SQL} SELECT {_FLAT} FROM cur WHERE {where}"


@query("search_scalar_exact", _search_sql("tld = 'com' AND registrar_id = 7"))
def _(spark, sf):
    return _found(spark, sf, ("tld", "exact", "com"), ("registrar_id", "exact", "7"))


@query("search_scalar_not", _search_sql("pm_username <> 'user-3' AND modified_by <> 'pi'"))
def _(spark, sf):
    return _found(spark, sf, ("pm_username", "not", "user-3"), ("modified_by", "not", "pi"))


@query("search_scalar_prefix_substring", _search_sql("starts_with(domain, 'customer-') AND contains(domain, '7.co')"))
def _(spark, sf):
    return _found(spark, sf, ("domain", "startswith", "customer-"), ("domain", "substring", "7.co"))


@query("search_array_exact", _search_sql("list_contains(status, 'clientHold')"))
def _(spark, sf):
    return _found(spark, sf, ("status", "exact", "clientHold"))


@query("search_array_not", _search_sql("NOT list_contains(status, 'ok')"))
def _(spark, sf):
    return _found(spark, sf, ("status", "not", "ok"))


@query("search_array_prefix", _search_sql("len([x for x in status if starts_with(x, 'pending')]) > 0"))
def _(spark, sf):
    return _found(spark, sf, ("status", "startswith", "pending"))


@query("search_array_substring", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT domain, array_to_string(ns, ',') AS ns
  FROM curns WHERE len([x for x in ns if contains(x, '-00000001')]) > 0""")
def _(spark, sf):
    cur = current_with_servers(spark, sf)
    return search.search(cur, [("ns", "substring", "-00000001")]).select("domain", text.list_text(F.col("ns")).alias("ns"))


@query("search_bool", _search_sql("registered = false"))
def _(spark, sf):
    return _found(spark, sf, *cr.available())


@query("search_bool_not", _search_sql("registered <> false"))
def _(spark, sf):
    return _found(spark, sf, ("registered", "not", "false"))


@query("search_preset_nameserver", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT domain, registered FROM curns
  WHERE list_contains(ns_domains, 'supplier-000000003.net')""")
def _(spark, sf):
    cur = current_with_servers(spark, sf, "registered")
    return search.search(cur, cr.on_nameserver_domain("supplier-000000003.net")).select("domain", "registered")


@query("search_preset_name", _search_sql("starts_with(domain, 'customer-00000001')"))
def _(spark, sf):
    return _found(spark, sf, *cr.named_like("customer-00000001"))


@query("refine_snapshot", f"""WITH {LOG_SQL} SELECT domain, registered, tld FROM cur
  WHERE registered = true AND tld = 'net'""")
def _(spark, sf):
    cur = current(spark, sf, "registered", "tld")
    store = search.snapshot(search.search(cur, [("registered", "exact", "true")]), 11)
    return search.refine(store, 11, [("tld", "exact", "net")])


@query("refilter_after_edit", f"""WITH {LOG_SQL} SELECT domain, registered, tld, CAST(12 AS BIGINT) AS search_id
  FROM cur WHERE tld = 'org'""")
def _(spark, sf):
    first = cr.check([("registered", "exact", "true"), ("tld", "exact", "net")])
    edited = search.changed_criterion(search.without_criterion(first, 0), 0, ("tld", "exact", "org"))
    return jobs.refresh_search(current(spark, sf, "registered", "tld"), edited, 12)


@query("search_page", f"""WITH {LOG_SQL} SELECT domain, visits_12m, pm_username FROM cur
  ORDER BY visits_12m DESC NULLS LAST, domain LIMIT 100 OFFSET 200""")
def _(spark, sf):
    return search.page(current(spark, sf, "visits_12m", "pm_username"), search.Page.parse("visits_12m/desc/100/200"))


@query("search_page_nulls_last", f"""WITH {LOG_SQL} SELECT domain, pm_username FROM cur
  ORDER BY pm_username ASC NULLS LAST, domain LIMIT 50 OFFSET 50""")
def _(spark, sf):
    return search.page(current(spark, sf, "pm_username"), search.Page("pm_username", "asc", 50, 50))


@query("keyset_page", f"""WITH {LOG_SQL} SELECT domain, visits_12m FROM cur WHERE domain > 'customer-000000042'
  ORDER BY domain LIMIT 100""")
def _(spark, sf):
    return search.page_keyset(current(spark, sf, "visits_12m"), "customer-000000042", 100)


_TAGS = [search.Tag(1, "free", "green", "bi-check", (("registered", "exact", "false"),)),
         search.Tag(2, "held", "red", "bi-lock", (("status", "exact", "clientHold"), ("tld", "exact", "com"))),
         search.Tag(3, "busy", "blue", "bi-star", (("domain", "substring", "99"),))]


@query("tag_rows", f"""WITH {LOG_SQL} SELECT domain, array_to_string([t FOR t IN [
  CASE WHEN registered = false THEN '1:free' END,
  CASE WHEN list_contains(status, 'clientHold') AND tld = 'com' THEN '2:held' END,
  CASE WHEN contains(domain, '99') THEN '3:busy' END] IF t IS NOT NULL], ',') AS tags FROM cur""")
def _(spark, sf):
    tagged = search.tag_rows(current(spark, sf, "registered", "status", "tld"), _TAGS)
    names = F.transform("tags", lambda t: F.concat_ws(":", t["id"].cast("string"), t["name"]))
    return tagged.select("domain", F.array_join(names, ",").alias("tags"))


@query("facet_scalar", f"""WITH {LOG_SQL} SELECT CASE WHEN tld = '' THEN '<empty>' ELSE tld END AS label,
  count(*) AS count FROM cur WHERE tld IS NOT NULL GROUP BY tld ORDER BY count DESC, tld LIMIT 100""")
def _(spark, sf):
    return search.facet(current(spark, sf, "tld"), "tld")


@query("facet_array", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT label, count(*) AS count
  FROM (SELECT unnest(ns_domains) AS label FROM curns) GROUP BY label ORDER BY count DESC, label LIMIT 100""")
def _(spark, sf):
    return search.facet(current_with_servers(spark, sf), "ns_domains")


@query("facet_servers_of_domain", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT label, count(*) AS count
  FROM (SELECT unnest(ns) AS label FROM curns WHERE list_contains(ns_domains, 'supplier-000000005.net'))
  WHERE ends_with(label, '.supplier-000000005.net') GROUP BY label ORDER BY count DESC, label LIMIT 100""")
def _(spark, sf):
    wanted = cr.on_nameserver_domain("supplier-000000005.net")
    return search.facet(search.search(current_with_servers(spark, sf), wanted), "ns", wanted)


@query("top_n_scalar", f"""WITH {LOG_SQL} SELECT pm_username AS val, count(*) AS count FROM cur GROUP BY val
  ORDER BY count DESC, val ASC NULLS LAST LIMIT 10""")
def _(spark, sf):
    return search.top_n(current(spark, sf, "pm_username"), "pm_username", 10)


@query("top_n_array", f"""WITH {LOG_SQL} SELECT array_to_string(status, ',') AS val, count(*) AS count FROM cur
  GROUP BY val""")
def _(spark, sf):
    top = search.top_n(current(spark, sf, "status"), "status", 10)
    return top.withColumn("val", text.list_text(F.col("val")))


_MONTHS = ", ".join(f"CAST(coalesce(sum(visits_12m) FILTER (month(last_modified) = {m}), 0) AS BIGINT)"
                    for m in range(1, 13))


@query("summary", f"""WITH {LOG_SQL} SELECT count(*) AS count,
  'false:' || count(*) FILTER (registered = false) || ',true:' || count(*) FILTER (registered) || ',unknown:' ||
  count(*) FILTER (registered IS NULL) AS registered,
  array_to_string([{_MONTHS}], ',') AS visits_arr_12m, CAST(sum(visits_12m) AS BIGINT) AS visits_12m FROM cur""")
def _(spark, sf):
    s = search.summary(current(spark, sf, "registered", "visits_arr_12m"))
    states = F.transform("registered", lambda r: F.concat_ws(
        ":", F.coalesce(r["registered"].cast("string"), F.lit("unknown")), r["count"].cast("string")))
    return s.select("count", F.array_join(states, ",").alias("registered"),
                    F.array_join(F.col("visits_arr_12m").cast("array<string>"), ",").alias("visits_arr_12m"), "visits_12m")


@query("row_count", f"WITH {LOG_SQL} SELECT count(*) AS count FROM cur WHERE registered")
def _(spark, sf):
    return search.row_count(search.search(current(spark, sf, "registered"), [("registered", "exact", "true")]))


@query("export_rows", f"""WITH {LOG_SQL} SELECT domain, registrar_id, visits_12m,
  array_to_string(status, ',') AS status, registered FROM cur WHERE registered ORDER BY domain DESC""")
def _(spark, sf):
    found = search.search(current(spark, sf, "registrar_id", "visits_12m", "status", "registered"),
                          [("registered", "exact", "true")])
    return search.export_rows(found)


@query("export_domain_list", f"WITH {LOG_SQL} SELECT domain FROM cur WHERE registered = false ORDER BY domain")
def _(spark, sf):
    return search.domain_list(search.search(current(spark, sf, "registered"), cr.available()))


@query("export_capped", f"WITH {LOG_SQL} SELECT domain FROM cur ORDER BY domain LIMIT 777")
def _(spark, sf):
    return search.first_by_key(current(spark, sf, "tld").select("domain"), 777, small=50).orderBy("domain")


@query("lookup_report", f"""WITH {LOG_SQL}, {SERVERS_SQL},
  rep AS (SELECT domain, array_to_string(ns, ',') AS ns, array_to_string(ns_domains, ',') AS nsd, last_modified, registrar_id
          FROM curns)
  SELECT domain, CASE WHEN contains(ns, 'supplier-000000001.net') THEN '' ELSE ns END AS ns,
  CASE WHEN contains(ns, 'supplier-000000001.net') THEN '' ELSE nsd END AS ns_domains,
  last_modified AS expiration_date, registrar_id FROM rep""")
def _(spark, sf):
    cur = current_with_servers(spark, sf, "last_modified", "registrar_id")
    return dims.lookup_report(cur.withColumnRenamed("last_modified", "expiration_date"), "supplier-000000001.net")


def _age_sql(age: str) -> str:
    """Label of an age in whole seconds; what is after the moment counts back from it."""
    day = f"({age} - CAST(floor({age} / 86400.0) AS BIGINT) * 86400)"
    return (f"CASE WHEN floor({age} / 86400.0) <> 0 THEN CAST(floor({age} / 86400.0) AS BIGINT) || ' days ago' "
            f"WHEN {day} >= 3600 THEN ({day} // 3600) || ' hours ago' WHEN {day} >= 60 THEN ({day} // 60) || ' minutes ago' ELSE {day} || ' seconds ago' END")


@query("age_labels", f"""WITH a AS (SELECT event_id, CASE event_type WHEN 'view' THEN CAST(floor(86400 - epoch(ts) % 86400) AS BIGINT)
    WHEN 'click' THEN CAST(floor(3600 - epoch(ts) % 3600) AS BIGINT) WHEN 'signup' THEN CAST(floor(60 - epoch(ts) % 60) AS BIGINT)
    ELSE CAST(floor(1706659200 - epoch(ts)) AS BIGINT) END AS age FROM events) SELECT event_id, {_age_sql('age')} AS label FROM a""")
def _(spark, sf):
    """Ages of events at the next midnight, hour or minute, or at the end of January, by their type."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    left = {"view": 86400, "click": 3600, "signup": 60}
    age = F.lit(1706659200 * 1_000_000) - at
    for kind, unit in left.items():
        age = F.when(F.col("event_type") == kind, F.lit(unit * 1_000_000) - F.pmod(at, F.lit(unit * 1_000_000))).otherwise(age)
    return table(spark, sf, "events").select("event_id", text.age_label(F.floor(age / 1_000_000)).alias("label"))


@query("display_labels", f"""WITH {LOG_SQL}, a AS (SELECT *, CAST(epoch(TIMESTAMP '{AS_OF_ORDERS}') -
    epoch(last_modified) AS BIGINT) AS age FROM cur)
  SELECT domain,
  CASE WHEN visits_12m * 100 > 1000000000 THEN printf('%.2fB', visits_12m * 100 / 1e9)
       WHEN visits_12m * 100 > 1000000 THEN printf('%.2fM', visits_12m * 100 / 1e6)
       ELSE format('{{:,}}', visits_12m * 100) END AS visits,
  strftime(last_modified, '%Y-%m-%d') AS day,
  CASE WHEN registered IS NULL THEN 'Unknown' WHEN registered THEN 'Registered' ELSE 'Available' END AS state,
  CASE WHEN tld = '' THEN '<empty>' ELSE tld END AS tld_label,
  {_age_sql('age')} AS age_label FROM a""")
def _(spark, sf):
    cur = current(spark, sf, "visits_12m", "last_modified", "registered", "tld")
    age = F.unix_seconds(F.lit(AS_OF_ORDERS).cast("timestamp")) - F.unix_seconds(F.col("last_modified").cast("timestamp"))
    return cur.select(
        "domain", text.number_label(F.col("visits_12m") * 100).alias("visits"),
        text.date_label(F.col("last_modified")).alias("day"), text.registered_label(F.col("registered")).alias("state"),
        text.empty_label(F.col("tld")).alias("tld_label"), text.age_label(age).alias("age_label"))


@query("short_texts", """SELECT doc_id, CASE WHEN length(text) > 55 THEN
  regexp_replace(substr(text, 1, 47), ' [^ ]*$', '') || '...' ELSE text END AS short FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.short_text(F.col("text")).alias("short"))


# --- selection ---------------------------------------------------------------------------------
@query("select_composite", f"""WITH {LOG_SQL} SELECT domain FROM cur WHERE modified_by <> 'pi'
  AND domain LIKE 'customer-%.co%' AND domain NOT LIKE '%1.%' AND domain NOT LIKE '%2.%' AND pm_username IS NOT NULL""")
def _(spark, sf):
    cur = current(spark, sf, "modified_by", "pm_username")
    return selection.select_domains(cur, not_modified_by="pi", domain_like="customer-%.co%",
                                    domain_not_like=["%1.%", "%2.%"], has_pm_username=True).select("domain")


@query("select_empty_tld", f"WITH {LOG_SQL} SELECT domain, modified_by FROM cur WHERE tld = '' AND modified_by = 'whois'")
def _(spark, sf):
    cur = current(spark, sf, "modified_by", "tld")
    return selection.select_domains(cur, tld="", modified_by="whois").select("domain", "modified_by")


@query("select_never_scraped", f"WITH {LOG_SQL} SELECT domain FROM cur WHERE dns_scraped IS NULL")
def _(spark, sf):
    return selection.select_domains(current(spark, sf, "dns_scraped"), never_scraped=["dns"]).select("domain")


@query("select_stale", f"""WITH {LOG_SQL} SELECT domain, whois_scraped FROM cur
  WHERE whois_scraped < TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 60 DAY""")
def _(spark, sf):
    return selection.select_domains(current(spark, sf, "whois_scraped"), as_of=AS_OF_ORDERS,
                                    scraped_days_ago={"whois": 60}, not_punycode=True)


@query("select_by_nameserver", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT domain FROM curns
  WHERE list_contains(ns_domains, 'supplier-000000009.net') AND NOT contains(domain, 'xn--')""")
def _(spark, sf):
    cur = current_with_servers(spark, sf)
    return selection.select_domains(cur, ns_domain="supplier-000000009.net", not_punycode=True).select("domain")


_UNSUPPORTED = ("('au', 'be', 'cm', 'cn', 'co', 'co.ke', 'co.kr', 'co.za', 'com.vn', 'de', 'eu', 'gr', 'hu', 'in', "
                "'io', 'it', 'ru', 'us', 'com.au')")


@query("select_rdap_supported", f"WITH {LOG_SQL} SELECT domain, tld FROM cur WHERE tld NOT IN {_UNSUPPORTED}")
def _(spark, sf):
    return selection.by_capability(current(spark, sf, "tld"), shaped.suffixes(spark), True)


@query("select_rdap_unsupported", f"WITH {LOG_SQL} SELECT domain, tld FROM cur WHERE tld IN {_UNSUPPORTED}")
def _(spark, sf):
    return selection.by_capability(current(spark, sf, "tld"), shaped.suffixes(spark), False)


@query("select_by_source", f"WITH {LOG_SQL} SELECT DISTINCT domain FROM cur WHERE modified_by IN ('pi', 'zonefile')")
def _(spark, sf):
    return selection.by_source(current(spark, sf, "modified_by"), ["pi", "zonefile"])


@query("shuffle_select", f"WITH {LOG_SQL} SELECT domain FROM cur ORDER BY md5(domain), domain LIMIT 200")
def _(spark, sf):
    return selection.shuffled(current(spark, sf, "seq").select("domain"), 200, portable=True)


def _route_sql(rows: str) -> str:
    """Requests of `rows(domain, scraper)`; suffix 'com.au' is the only unsupported one here."""
    return (f"SELECT 'scrape.' || CASE WHEN scraper = 'whois' AND NOT ends_with(domain, '.com.au') THEN 'rdap' "
            f"ELSE scraper END AS topic, domain AS key, '{{}}' AS value FROM {rows}")


@query("queue_scrapes", f"""WITH {LOG_SQL}, pairs AS (SELECT domain, unnest(['dns', 'whois']) AS scraper FROM cur
  WHERE registered IS NULL) {_route_sql('pairs')}""")
def _(spark, sf):
    names = current(spark, sf, "registered").where(F.col("registered").isNull())
    return jobs.queue_scrapes(names, ["dns", "whois"], shaped.suffixes(spark))


@query("queue_scrapes_limited", f"""WITH {LOG_SQL}, few AS (SELECT domain FROM cur ORDER BY domain LIMIT 150),
  pairs AS (SELECT domain, unnest(['rdap', 'whois']) AS scraper FROM few) {_route_sql('pairs')}""")
def _(spark, sf):
    return jobs.queue_scrapes(current(spark, sf, "tld"), ["rdap", "whois"], shaped.suffixes(spark), limit=150)


@query("queue_new", f"""WITH {LOG_SQL}, names AS (SELECT domain FROM cur WHERE modified_by IN ('pi', 'zonefile'))
  SELECT 'scrape.dns' AS topic, domain AS key, '{{}}' AS value FROM names
  UNION ALL SELECT 'scrape.rdap', domain, '{{}}' FROM names""")
def _(spark, sf):
    return jobs.queue_new(current(spark, sf, "modified_by"), shaped.suffixes(spark))


# names with internationalised labels at their start or in their middle, below gov and us, or with these as inner labels only
_MIXED_SQL = """names AS (SELECT CASE o_orderstatus WHEN 'P' THEN 'xn--' WHEN 'F' THEN 'a-xn--b.' ELSE '' END
    || CASE o_orderkey % 5 WHEN 0 THEN 'city' || o_orderkey || '.gov' WHEN 1 THEN 't' || o_orderkey || '.us'
       WHEN 2 THEN 'www.gov.n' || o_orderkey || '.com' WHEN 3 THEN 'us.n' || o_orderkey || '.com.au' ELSE 'us' || o_orderkey || '.com' END AS domain,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'zonefile' WHEN '4-NOT SPECIFIED' THEN 'pi' ELSE 'dns' END AS modified_by FROM orders)"""


def _mixed_names(spark, sf):
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    start = F.when(F.col("o_orderstatus") == "P", "xn--").when(F.col("o_orderstatus") == "F", "a-xn--b.").otherwise("")
    rest = (F.when(kind == 0, F.concat(F.lit("city"), key, F.lit(".gov"))).when(kind == 1, F.concat(F.lit("t"), key, F.lit(".us")))
            .when(kind == 2, F.concat(F.lit("www.gov.n"), key, F.lit(".com"))).when(kind == 3, F.concat(F.lit("us.n"), key, F.lit(".com.au")))
            .otherwise(F.concat(F.lit("us"), key, F.lit(".com"))))
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "zonefile").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "pi").otherwise("dns")
    return table(spark, sf, "orders").select(F.concat(start, rest).alias("domain"), source.alias("modified_by"))


def _public_suffixes(spark):
    return Suffixes.of(spark, [*shaped.SUFFIXES, "gov", "us"])


@query("select_without_punycode", f"WITH {_MIXED_SQL} SELECT domain, modified_by FROM names WHERE modified_by = 'pi' AND NOT contains(domain, 'xn--')")
def _(spark, sf):
    return selection.select_domains(_mixed_names(spark, sf), modified_by="pi", not_punycode=True)


@query("scraper_by_suffix", f"""WITH {_MIXED_SQL} SELECT domain, modified_by,
  CASE WHEN ends_with(domain, '.gov') OR ends_with(domain, '.us') THEN 'whois' ELSE 'rdap' END AS scraper FROM names""")
def _(spark, sf):
    return selection.preferred_scraper(_mixed_names(spark, sf), _public_suffixes(spark))


@query("queue_new_by_suffix", f"""WITH {_MIXED_SQL}, new AS (SELECT DISTINCT domain FROM names WHERE modified_by IN ('pi', 'zonefile'))
  SELECT 'scrape.dns' AS topic, domain AS key, '{{}}' AS value FROM new UNION ALL
  SELECT CASE WHEN ends_with(domain, '.us') THEN 'scrape.whois' ELSE 'scrape.rdap' END, domain, '{{}}' FROM new""")
def _(spark, sf):
    return jobs.queue_new(_mixed_names(spark, sf), _public_suffixes(spark))


@query("tag_lookups", """WITH tags AS (SELECT p_partkey AS id, p_name AS name, p_size AS search_id FROM part)
  SELECT 'id' AS by_, id, name, search_id FROM tags WHERE id = 12
  UNION ALL (SELECT 'search', id, name, search_id FROM tags WHERE search_id = 7 ORDER BY id LIMIT 1)""")
def _(spark, sf):
    tags = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("search_id"))
    found = [("id", search.tag_by_id(tags, 12)), ("search", search.tag_of_search(tags, 7))]
    return reduce(DataFrame.unionByName, [rows.select(F.lit(by).alias("by_"), "*") for by, rows in found])


def _bootstrap(spark, sf):
    """Server list as it is published, one document per nation: `services: [[suffixes], [url]]`."""
    n = table(spark, sf, "nation")
    pair = F.when(F.col("n_nationkey") == 0, F.lit('"com","net"')).when(F.col("n_nationkey") == 1, F.lit('"com.au"')) \
        .otherwise(F.concat(F.lit('"x'), F.col("n_nationkey"), F.lit('"')))
    doc = F.concat(F.lit('{"services":[[['), pair, F.lit('],["https://rdap.'), F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))),
                   F.lit('.example/v1/"]]]}'))
    return n.select(doc.alias("value"))


@query("rdap_bootstrap_rows", """SELECT t AS tld, 'https://rdap.' || lower(replace(n_name, '_', '-')) || '.example/v1/' AS url
  FROM (SELECT n_name, unnest(CASE n_nationkey WHEN 0 THEN ['com', 'net'] WHEN 1 THEN ['com.au'] ELSE ['x' || n_nationkey] END)
  AS t FROM nation)""")
def _(spark, sf):
    from zonewright.sources.tables import bootstrap_rows
    return bootstrap_rows(_bootstrap(spark, sf))


@query("queue_rdap_by_shard", f"""WITH {LOG_SQL}, n AS (SELECT domain, CASE WHEN ends_with(domain, '.com.au') THEN 'nation-1'
    WHEN ends_with(domain, '.com') OR ends_with(domain, '.net') THEN 'nation-0' END AS host FROM cur WHERE modified_by = 'dns')
  SELECT 'scrape.rdap.rdap_' || host || '_example_v1' AS topic, domain AS key, '{{}}' AS value FROM n WHERE host IS NOT NULL""")
def _(spark, sf):
    from zonewright.sources.tables import bootstrap_rows
    return jobs.queue_rdap_by_shard(current(spark, sf, "modified_by"), bootstrap_rows(_bootstrap(spark, sf)),
                                    shaped.suffixes(spark))
