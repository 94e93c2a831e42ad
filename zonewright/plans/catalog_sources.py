"""Registered queries: names, dimensions, extraction, lookups. Each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright import schema
from zonewright.functions import text
from zonewright.operators import dims, enrich, extract_dns, extract_rdap, extract_whois, extractors, merge, names
from zonewright.plans import jobs, shaped
from zonewright.plans.shaped import HOSTS_SQL, LOG_SQL, NORMALIZED_SQL, SERVERS_SQL, current, page_hosts, spread_table, suffix_sql, table
from zonewright.sources import tables

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


# --- suffixes ----------------------------------------------------------------------------------
_PAGE_SUFFIX = f"{HOSTS_SQL}, m AS ({suffix_sql('hosts', 'hosts.host', 'page_id')})"


@query("suffix_of", f"WITH {_PAGE_SUFFIX} SELECT page_id, host, suffix FROM m")
def _(spark, sf):
    return names.suffix_of(page_hosts(spark, sf), "host", shaped.suffixes(spark))


@query("normalize", f"WITH {_PAGE_SUFFIX} SELECT page_id, host, {NORMALIZED_SQL} AS normalized FROM m")
def _(spark, sf):
    return names.normalize(page_hosts(spark, sf), "host", shaped.suffixes(spark))


_SUFFIX_OF_LABELS = f"""WITH {HOSTS_SQL}, cand AS (SELECT DISTINCT regexp_extract(host, '[^.]+[.][^.]+$') AS suffix FROM hosts
    UNION SELECT DISTINCT regexp_extract(host, '[^.]+$') FROM hosts),
  m AS (SELECT page_id, host, arg_max(suffix, length(suffix)) AS suffix FROM hosts LEFT JOIN cand ON ends_with(host, '.' || suffix)
    GROUP BY ALL)"""


@query("suffix_of_derived_table", f"{_SUFFIX_OF_LABELS} SELECT page_id, host, suffix FROM m")
def _(spark, sf):
    hosts = page_hosts(spark, sf)
    seen = hosts.select(F.explode(F.array(F.substring_index("host", ".", -1), F.substring_index("host", ".", -2))).alias("value"))
    lines = seen.distinct().unionByName(seen.select(F.concat(F.lit("// "), F.col("value")).alias("value")).distinct())
    return names.suffix_of(hosts, "host", names.Suffixes.from_table(tables.suffix_lines(lines)))


@query("only_normalized", f"WITH {_PAGE_SUFFIX} SELECT page_id, host FROM m WHERE {NORMALIZED_SQL} = host")
def _(spark, sf):
    hosts = page_hosts(spark, sf).withColumn("host", F.regexp_replace("host", r"^(www|m|blog)\.", ""))
    return names.only_normalized(hosts, "host", shaped.suffixes(spark))


ORACLES["only_normalized"] = f"""WITH h0 AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages),
  hosts AS (SELECT page_id, regexp_replace(host, '^(www|m|blog)[.]', '') AS host FROM h0),
  sfx AS (SELECT unnest({shaped.SUFFIXES}) AS suffix), m AS ({suffix_sql('hosts', 'hosts.host', 'page_id')})
  SELECT page_id, host FROM m WHERE {NORMALIZED_SQL} = host"""


@query("import_names_counts", f"WITH {_PAGE_SUFFIX} SELECT count(suffix) AS valid, count(*) - count(suffix) AS invalid FROM m")
def _(spark, sf):
    upper = page_hosts(spark, sf).select(F.concat(F.lit("  "), F.upper("host"), F.lit(" ")).alias("value"))
    return tables.import_names(tables.clean_names(upper), shaped.suffixes(spark))[1]


@query("import_names_updates", f"""WITH {_PAGE_SUFFIX} SELECT {NORMALIZED_SQL} AS domain, 'Result' AS type,
  'csv_import' AS modified_by FROM m WHERE suffix IS NOT NULL""")
def _(spark, sf):
    upper = page_hosts(spark, sf).select(F.concat(F.lit("  "), F.upper("host"), F.lit(" ")).alias("value"))
    return tables.import_names(tables.clean_names(upper), shaped.suffixes(spark))[0]


@query("normalize_list", f"""WITH {LOG_SQL}, {SERVERS_SQL} SELECT domain, array_to_string(ns_domains, ',') AS ns_domains FROM curns""")
def _(spark, sf):
    cur = shaped.current_with_servers(spark, sf).select("domain", "ns")
    lists = names.normalize_list(cur, "ns", shaped.suffixes(spark), ["domain"])
    return lists.withColumn("ns_domains", text.list_text(F.col("ns_domains")))


@query("normalise_ns_domains", f"""WITH {LOG_SQL}, {SERVERS_SQL}, raw AS (SELECT domain,
    CASE WHEN tld = 'com' THEN list_reverse(ns_domains) WHEN tld = 'net' THEN ['localhost'] ELSE ns END AS nd, ns_domains FROM curns)
  SELECT domain, array_to_string(CASE WHEN len(nd) = 0 OR nd = ['localhost'] THEN nd ELSE ns_domains END, ',') AS ns_domains FROM raw""")
def _(spark, sf):
    cur = shaped.current_with_servers(spark, sf, "tld")
    mixed = cur.select("domain", F.when(F.col("tld") == "com", F.reverse("ns_domains"))
                       .when(F.col("tld") == "net", F.array(F.lit("localhost"))).otherwise(F.col("ns")).alias("ns_domains"))
    return names.normalise_ns_domains(mixed, shaped.suffixes(spark)).withColumn("ns_domains", text.list_text(F.col("ns_domains")))


_REAL_TLD = "regexp_replace(domain, '^[^.]+[.]', '')"


@query("audit_tlds", f"""WITH {LOG_SQL} SELECT domain, tld AS in_db_tld, {_REAL_TLD} AS python_tld_method FROM cur
  WHERE tld <> {_REAL_TLD} AND tld <> ''""")
def _(spark, sf):
    return names.audit_tlds(current(spark, sf, "tld"), shaped.suffixes(spark))


@query("repair_tlds", f"WITH {LOG_SQL} SELECT domain, CASE WHEN tld = '' THEN '' ELSE {_REAL_TLD} END AS tld FROM cur")
def _(spark, sf):
    cur = current(spark, sf, "tld")
    return names.repair_tlds(cur, names.audit_tlds(cur, shaped.suffixes(spark)))


@query("unicode_tlds", """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'বাংলা' WHEN 'N' THEN 'com' ELSE '中国' END AS tld
  FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", "xn--54b7fta0cc").when(
        F.col("l_returnflag") == "N", "com").otherwise("xn--fiqs8s").alias("tld"))
    return names.unicode_tlds(li)


# --- lookups and dimensions ------------------------------------------------------------------------
@query("bulk_lookup", """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders
  WHERE o_orderstatus = 'P')""")
def _(spark, sf):
    asked = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return dims.bulk_lookup(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), asked, "c_custkey")


@query("missing_names", """SELECT DISTINCT user_id AS o_custkey FROM events WHERE user_id NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""")
def _(spark, sf):
    have = table(spark, sf, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
    asked = table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"))
    return dims.missing_names(asked, have.select("o_custkey"), "o_custkey")


@query("copy_if_absent", """SELECT p_partkey AS id, p_name AS criteria FROM part WHERE p_size <= 25
  UNION ALL SELECT p_partkey, upper(p_name) FROM part WHERE p_size > 25""")
def _(spark, sf):
    p = table(spark, sf, "part")
    mine = p.where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("criteria"))
    theirs = p.select(F.col("p_partkey").alias("id"), F.upper("p_name").alias("criteria"))
    return dims.copy_if_absent(mine, theirs, "id")


def _registrars(spark, sf):
    """Parts as two registrar lists that overlap: small sizes only in one, repeats within it."""
    p = table(spark, sf, "part")
    rows = p.select(F.col("p_size").cast("bigint").alias("registrar_id"), F.concat("p_name", F.lit(" "), "p_brand").alias("registrar_name"),
                    F.col("p_partkey").alias("row_no"), "p_type")
    au = rows.where(F.col("p_type").isin("ECONOMY", "SMALL", "PROMO")).drop("p_type")
    main = rows.where((F.col("p_type") == "LARGE") & (F.col("registrar_id") > 20)).drop("p_type")
    return au, main


_REGISTRARS_SQL = """regs AS (SELECT CAST(p_size AS BIGINT) AS registrar_id, lower(p_name || ' ' || p_brand) AS registrar_name, 0 AS rank, p_partkey AS row_no
    FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO')
  UNION ALL SELECT p_size, p_name || ' ' || p_brand, 1, p_partkey FROM part WHERE p_type = 'LARGE' AND p_size > 20),
reg AS (SELECT registrar_id, registrar_name FROM regs QUALIFY row_number() OVER (PARTITION BY registrar_id ORDER BY rank DESC, row_no DESC) = 1)"""


@query("union_registrars", f"WITH {_REGISTRARS_SQL} SELECT registrar_id, registrar_name FROM reg")
def _(spark, sf):
    return dims.union_registrars(*_registrars(spark, sf))


def _dimension(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("registrar_id"), F.lower("n_name").alias("registrar_name"))


@query("upsert_dimension", f"""WITH {_REGISTRARS_SQL}, d AS (SELECT CAST(n_nationkey AS BIGINT) AS registrar_id, lower(n_name) AS registrar_name FROM nation)
  SELECT coalesce(reg.registrar_id, d.registrar_id) AS registrar_id, CASE WHEN reg.registrar_id IS NOT NULL THEN reg.registrar_name
  ELSE d.registrar_name END AS registrar_name FROM reg FULL JOIN d ON reg.registrar_id = d.registrar_id""")
def _(spark, sf):
    return dims.upsert_dimension(_dimension(spark, sf), dims.union_registrars(*_registrars(spark, sf)), "registrar_id", "registrar_name")[0]


@query("upsert_dimension_changed", """SELECT p_partkey, CASE WHEN p_size > 40 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice
  FROM part WHERE p_size > 40 OR p_type = 'PROMO'""")
def _(spark, sf):
    p = table(spark, sf, "part")
    old = p.where(F.col("p_type") != "PROMO").select("p_partkey", "p_retailprice")
    new = p.select("p_partkey", F.when(F.col("p_size") > 40, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return dims.upsert_dimension(old, new, "p_partkey", "p_retailprice")[1]


@query("refresh_registrars", f"""WITH {_REGISTRARS_SQL} SELECT c_custkey AS domain, CAST(c_nationkey AS BIGINT) AS registrar_id,
  coalesce(reg.registrar_name, c_name) AS registrar_name FROM customer LEFT JOIN reg ON reg.registrar_id = c_nationkey""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("domain"), F.col("c_nationkey").cast("bigint").alias("registrar_id"),
                                            F.col("c_name").alias("registrar_name"))
    return jobs.refresh_registrars(_dimension(spark, sf), *_registrars(spark, sf), c)[1]


def _registry(spark, sf):
    o = table(spark, sf, "orders")
    domains = o.select(F.col("o_orderkey").alias("id"), F.format_string("d%d.com", F.col("o_orderkey")).alias("domain"),
                       F.when(F.col("o_orderstatus") == "F", "Not Available").when(F.col("o_orderstatus") == "O", "AVAILABLE")
                       .otherwise("Unknown").alias("whois_check_status"))
    info = o.where(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderkey").alias("domain_id"), F.add_months(
        F.to_date("o_orderdate"), -150).alias("estimated_created_date"))
    return domains, info


_REGISTRY_SQL = """rs AS (SELECT o_orderkey, 'd' || o_orderkey || '.com' AS domain, o_orderstatus = 'F' AS registered,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) - INTERVAL 150 MONTH END AS d FROM orders WHERE o_orderstatus IN ('F', 'O')),
rg AS (SELECT o_orderkey, domain, registered, CASE WHEN d >= TIMESTAMP '1985-01-01' THEN CAST(d AS TIMESTAMP) END AS registration_date FROM rs)"""


@query("registry_status", f"WITH {_REGISTRY_SQL} SELECT domain, registered, registration_date FROM rg")
def _(spark, sf):
    return dims.registry_status(*_registry(spark, sf)).withColumn("registration_date", F.col("registration_date").cast("timestamp_ntz"))


@query("load_registry_status", f"""WITH {_REGISTRY_SQL} SELECT domain, registered, registration_date FROM rg
  WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)""")
def _(spark, sf):
    have = table(spark, sf, "customer").select(F.format_string("d%d.com", F.col("c_custkey")).alias("domain"))
    rows = jobs.load_registry_status(have, *_registry(spark, sf))
    return rows.withColumn("registration_date", F.col("registration_date").cast("timestamp_ntz"))


@query("status_requests", "SELECT 'scrape.dns' AS topic, 'd' || o_orderkey || '.com' AS key, '{}' AS value FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return tables.status_requests(_registry(spark, sf)[0])


@query("ownership_updates", """SELECT 'd' || o_orderkey || '.com' AS domain, c_name AS pm_username, o_orderdate AS pm_added,
  CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END AS pm_blacklisted FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_orderpriority <> '1-URGENT'""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    sub = F.when(F.col("o_orderpriority") == "1-URGENT", "www.").otherwise("")
    owned = o.select(F.concat(sub, F.format_string("d%d.com", F.col("o_orderkey"))).alias("nam"), F.col("o_custkey").alias("owner"),
                     F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("interval 1 day")).alias("blacklisted"),
                     F.col("o_orderdate").alias("added"))
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nam"))
    up = tables.ownership_updates(dims.ownership_rows(owned, users), shaped.suffixes(spark))
    return up.select("domain", "pm_username", "pm_added", "pm_blacklisted")


@query("traffic_updates", """SELECT 't' || event_id || '.net' AS domain, CAST(round(value * 100) AS BIGINT) AS visits_12m, user_id AS hits_12m,
  CAST(ts AS DATE) AS last_visit_date, event_type AS hits_geo, event_id AS pi_rank, user_id || ',' || event_id AS visits_arr_12m
  FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    up = tables.traffic_updates(_traffic(spark, sf), shaped.suffixes(spark))
    return up.select("domain", "visits_12m", "hits_12m", "last_visit_date", "hits_geo", "pi_rank",
                     F.array_join(F.col("visits_arr_12m").cast("array<string>"), ",").alias("visits_arr_12m"))


def _traffic(spark, sf):
    """Events as traffic rows; those of errors are of no registrable name."""
    e = table(spark, sf, "events")
    rows = e.select(F.concat(F.when(F.col("event_type") == "error", "a.b.").otherwise(""), F.format_string("t%d.net", F.col("event_id"))).alias("domain"),
                    F.round(F.col("value") * 100).alias("visits"), F.to_date("ts").alias("lastdate"), F.col("user_id").alias("hits"),
                    F.col("event_type").alias("geo"), F.array("user_id", "event_id").alias("visits_arr"), F.col("event_id").alias("rank"))
    return rows.select(*tables.TRAFFIC_COLS)


@query("traffic_into_rows", """SELECT event_id AS seq, 't' || event_id || '.net' AS domain, 'net' AS tld, 'pi' AS modified_by,
  CAST(round(value * 100) AS BIGINT) AS visits_12m, event_type AS hits_geo, CAST(ts AS DATE) AS pi_import_date,
  CAST(NULL AS BOOLEAN) AS registered, '' AS rcode FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    up = tables.traffic_updates(_traffic(spark, sf), shaped.suffixes(spark))
    updates = merge.as_updates(up, F.col("pi_rank"), F.col("last_visit_date").cast("timestamp"))
    rows, _rejected = merge.apply_updates(updates.select(*schema.TABLE_COLS).limit(0), updates, shaped.suffixes(spark))
    return rows.select("seq", "domain", "tld", "modified_by", "visits_12m", "hits_geo", "pi_import_date", "registered", "rcode")


# --- extraction ----------------------------------------------------------------------------------
def whois_captures(spark, sf):
    """Orders as text responses: labels repeated, blank or missing, one or two statuses, some names free."""
    o = spread_table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    found = F.concat(
        F.lit("Domain Name: D"), F.col("o_orderkey"), F.lit(".COM\r\nUpdated Date: 1990-01-01T00:00:00Z\r\n   Updated Date: "), day,
        F.when(prio == "5-LOW", " soon").otherwise("T10:20:30Z"),
        F.lit("\r\nCreation Date: "), day, F.lit("T00:00:00Z\nRegistrar: "), F.col("c_mktsegment"), F.lit(" Registrar \n"),
        F.when(prio == "1-URGENT", F.concat(F.lit("Registrar IANA ID: "), F.col("c_nationkey"), F.lit("\n"))).otherwise(""),
        F.lit("Status Reason: none\nDomain Status: ok https://icann.example/epp#ok\n"),
        F.when(status == "P", "Status: clientHold https://icann.example/epp#clientHold\n").otherwise(""),
        F.lit("Registrant Name: "), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")),
        F.lit("\nRegistrant Contact Name:  "), F.when(F.col("c_acctbal") < 500, "").otherwise(F.lower("c_name")),
        F.lit("\nAdmin Country: N"), F.col("c_nationkey"), F.lit("\nEligibility Type: "), F.col("c_mktsegment"), F.lit("\n>>> end"))
    return o.select(F.format_string("D%d.com", F.col("o_orderkey")).alias("domain"),
                    F.when((status == "O") & (prio == "2-HIGH"), F.concat(F.lit("No match for \"D"), F.col("o_orderkey"), F.lit(".COM\".\n")))
                    .otherwise(found).alias("whois_text"))


def _segment_ids(spark, sf):
    """Registrar ids by name from the customers: every segment but one has an id."""
    c = table(spark, sf, "customer").where(F.col("c_mktsegment") != "FURNITURE")
    return c.groupBy(F.concat("c_mktsegment", F.lit(" Registrar")).alias("registrar_name")).agg(F.min("c_custkey").alias("registrar_id"))


_WHOIS_SQL = """seg AS (SELECT c_mktsegment AS s, min(c_custkey) AS id FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY s),
w AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN c_nationkey ELSE seg.id END AS rid,
  o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AS nx FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN seg ON seg.s = c_mktsegment)"""


@query("extract_whois_records", f"""WITH {_WHOIS_SQL} SELECT 'd' || o_orderkey || '.com' AS domain, CAST(rid AS BIGINT) AS registrar_id,
  o_orderdate + INTERVAL '10:20:30' HOUR TO SECOND AS last_changed_date, o_orderdate AS registration_date, c_mktsegment || ' Registrar' AS registrar_name,
  CASE WHEN o_orderstatus = 'P' THEN 'ok,clientHold' ELSE 'ok' END AS status,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 500 THEN c_name ELSE lower(c_name) END AS registrant_name,
  'N' || c_nationkey AS admin_country, c_mktsegment AS eligibility_type, CAST(NULL AS VARCHAR) AS tech_email
  FROM w WHERE NOT nx AND o_orderpriority <> '5-LOW' AND rid IS NOT NULL""")
def _(spark, sf):
    records, _nx, _bad = extract_whois.extract_whois(whois_captures(spark, sf), _segment_ids(spark, sf))
    return records.select("domain", "registrar_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("last_changed_date", "registration_date")],
                          "registrar_name", text.list_text(F.col("status")).alias("status"), "registrant_name", "admin_country",
                          "eligibility_type", "tech_email")


ORACLES["extract_whois_records"] = ORACLES["extract_whois_records"].replace(
    "INTERVAL '10:20:30' HOUR TO SECOND", "INTERVAL 37230 SECOND")


@query("extract_whois_nx", f"WITH {_WHOIS_SQL} SELECT 'd' || o_orderkey || '.com' AS domain, false AS registered FROM w WHERE nx")
def _(spark, sf):
    return extract_whois.extract_whois(whois_captures(spark, sf), _segment_ids(spark, sf))[1].select("domain", "registered")


@query("extract_whois_rejected", f"""WITH {_WHOIS_SQL} SELECT 'D' || o_orderkey || '.com' AS domain,
  concat_ws('; ', CASE WHEN rid IS NULL THEN 'unknown registrar' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'bad last_changed_date' END)
  AS reason FROM w WHERE NOT nx AND (o_orderpriority = '5-LOW' OR rid IS NULL)""")
def _(spark, sf):
    return extract_whois.extract_whois(whois_captures(spark, sf), _segment_ids(spark, sf))[2]


def _phrases_sql(col: str) -> str:
    return " OR ".join(f"contains({col}, '{p}')" for p in extract_whois.NO_MATCH)


@query("whois_no_match_flags", f"""SELECT 'd' || doc_id AS domain, {_phrases_sql('text')} AS no_match FROM documents
  UNION ALL SELECT 'p' || page_id, {_phrases_sql('html')} FROM pages""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("domain"), F.col("text"))
    both = docs.unionByName(table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id")).alias("domain"), F.col("html").alias("text")))
    return both.select("domain", extract_whois.is_no_match(F.col("text")).alias("no_match"))


@query("label_lines_of_documents", """SELECT doc_id, CAST(len(regexp_extract_all(text, '(?m)^[^:\\n]*:[ \\t]*(\\S[^\\n]*)$', 1)) AS INTEGER) AS n,
  regexp_extract_all(text, '(?m)^[^:\\n]*:[ \\t]*(\\S[^\\n]*)$', 1)[-1] AS last_value FROM documents""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", extract_whois.label_lines(F.col("text")).alias("lines"))
    return d.select("doc_id", F.size("lines").alias("n"), F.try_element_at("lines", F.lit(-1))["value"].alias("last_value"))


@query("referral_server", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'whois.' || lower(o_orderpriority[1:1]) || '.example' END AS server FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    body = F.concat(F.lit("Name: x\n"), F.when(F.col("o_orderstatus") == "F", "REGISTRAR WHOIS SERVER: ").when(
        F.col("o_orderstatus") == "O", "Registrar WHOIS Server:").otherwise("WHOIS: "), F.lit("whois."), F.lower(F.substring("o_orderpriority", 1, 1)),
        F.lit(".example\nEnd"))
    return o.select("o_orderkey", text.referral_server(body).alias("server"))


@query("timestamps_rendered", """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN ''
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03-0700' WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03+0000'
  ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00+0000' END AS shown FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    day, prio = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    raw = (F.when(prio == "5-LOW", F.concat(F.lit("on "), day)).when(prio == "1-URGENT", F.concat(day, F.lit("T01:02:03-0700")))
           .when(prio == "2-HIGH", F.concat(day, F.lit("T01:02:03Z"))).when(prio == "3-MEDIUM", F.date_format("o_orderdate", "dd.MM.yyyy"))
           .otherwise(day))
    return o.select("o_orderkey", text.render_timestamp(raw).alias("shown"))


def rdap_captures(spark, sf):
    """Orders as RDAP answers: several spellings and shapes, some statuses that are no record."""
    o = spread_table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey").cast("string")
    ident = F.concat(F.lit('[{"type":"other","identifier":"x"},{"type":"IANA Registrar ID","'),
                     F.when(prio == "2-HIGH", "Identifier").otherwise("identifier"), F.lit('": "'), F.col("c_nationkey"), F.lit('"}]'))
    card = F.concat(F.lit('["vcard",[["version",{},"text","4.0"],["fn",{},"text","'), F.col("c_name"),
                    F.lit('"],["org",{},"text","'), F.col("c_mktsegment"), F.lit('"],["tel",{"type":"voice"},"uri","tel:+1.'), key,
                    F.lit('"],["adr",{},"text",["","","Street 1","City","ST'), F.col("c_nationkey"), F.lit('","12345","'),
                    F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.lit("C"), F.col("c_nationkey"))), F.lit('"]]]]'))
    late = F.lit('["vcard",[["email",{},"text","late@example.com"],["org",{},"text",""]]]')
    body = F.concat(
        F.lit('{"objectClassName":"domain","status":'), F.when(status == "O", '"active"').otherwise('["active","locked"]'),
        F.when(prio == "4-NOT SPECIFIED", F.concat(F.lit(',"publicIds":'), ident)).otherwise(""),
        F.lit(',"events":[{"eventAction":"registration","eventDate":"'), day, F.when(prio == "2-HIGH", " 01:00:00").otherwise("T01:00:00.5Z"),
        F.lit('"},{"eventAction":"'), F.when(prio == "3-MEDIUM", "soft expiration").otherwise("expiration"), F.lit('","eventDate":"'), day,
        F.lit('T02:00:00Z"},{"eventAction":"registration","eventDate":"1990-01-01T00:00:00Z"}],"entities":[{"handle":"R","roles":["registrar"],"'),
        F.when(prio == "2-HIGH", "publicIDs").otherwise("publicIds"), F.lit('":'),
        F.when(prio == "4-NOT SPECIFIED", "[]").otherwise(ident), F.lit('},{"handle":"H","roles":["registrant","technical"],"vcardArray":'), card,
        F.lit('},{"handle":"L","roles":["administrative","technical"],"vcardArray":'), late, F.lit('}]}'))
    code = (F.when((status == "P") & (prio == "1-URGENT"), 404).when((status == "P") & (prio == "2-HIGH"), 429)
            .when((status == "P") & (prio == "3-MEDIUM"), 500).otherwise(200))
    broken = (status == "P") & (prio == "5-LOW")
    return o.select(F.format_string("D%d.com", F.col("o_orderkey")).alias("domain"), code.alias("status_code"),
                    F.when(broken, '{"errorCode":1}').otherwise(body).alias("rdap_json"))


@query("extract_rdap_records", """SELECT 'd' || o_orderkey || '.com' AS domain,
  o_orderdate + INTERVAL 3600 SECOND + CASE WHEN o_orderpriority = '2-HIGH' THEN INTERVAL 0 SECOND ELSE INTERVAL 500 MILLISECOND END AS registration_date,
  o_orderdate + INTERVAL 7200 SECOND AS expiration_date, CAST(NULL AS TIMESTAMP) AS last_changed_date, CAST(c_nationkey AS BIGINT) AS registrar_id,
  CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'active,locked' END AS status, c_name AS registrant_name, c_mktsegment AS registrant_organization,
  'tel:+1.' || o_orderkey AS registrant_phone, 'ST' || c_nationkey AS registrant_stateprovince,
  CASE WHEN c_acctbal >= 0 THEN 'C' || c_nationkey END AS registrant_country, CAST(NULL AS VARCHAR) AS registrant_email,
  c_name AS tech_name, '' AS tech_organization, 'late@example.com' AS tech_email, CAST(NULL AS VARCHAR) AS admin_name, 'late@example.com' AS admin_email,
  CAST(1 AS INTEGER) AS tech_adrs, CAST(0 AS INTEGER) AS admin_adrs
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' OR o_orderpriority = '4-NOT SPECIFIED'""")
def _(spark, sf):
    r = extract_rdap.extract_rdap(rdap_captures(spark, sf))["records"]
    dates = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("registration_date", "expiration_date", "last_changed_date")]
    plain = ["registrant_name", "registrant_organization", "registrant_phone", "registrant_stateprovince", "registrant_country",
             "registrant_email", "tech_name", "tech_organization", "tech_email", "admin_name", "admin_email"]
    return r.select("domain", *dates, "registrar_id", text.list_text(F.col("status")).alias("status"), *plain,
                    F.size("tech_adr").alias("tech_adrs"), F.size("admin_adr").alias("admin_adrs"))


@query("extract_rdap_outcomes", """SELECT 'd' || o_orderkey || '.com' AS domain, CASE o_orderpriority WHEN '1-URGENT' THEN 'nx' WHEN '2-HIGH' THEN 'throttled'
  WHEN '3-MEDIUM' THEN 'failed' ELSE 'rejected: not an RDAP domain object' END AS outcome
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED'""")
def _(spark, sf):
    parts = extract_rdap.extract_rdap(rdap_captures(spark, sf))
    out = [parts[n].select("domain", F.lit(n).alias("outcome")) for n in ("nx", "throttled", "failed")]
    out.append(parts["rejected"].select("domain", F.concat(F.lit("rejected: "), F.col("reason")).alias("outcome")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("retry_throttled", """SELECT 'scrape.rdap' AS topic, 'd' || o_orderkey || '.com' AS key, '{}' AS value, CAST(1 AS INTEGER) AS attempt FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'""")
def _(spark, sf):
    return extract_rdap.retry_requests(extract_rdap.extract_rdap(rdap_captures(spark, sf))["throttled"])


@query("captures_into_rows", f"""WITH {_WHOIS_SQL},
  u AS (SELECT o_orderkey AS k, 1 AS seq, 'whois' AS by_, CASE WHEN NOT nx THEN rid END AS rid, NOT nx AS reg FROM w
      WHERE nx OR (o_orderpriority <> '5-LOW' AND rid IS NOT NULL)
    UNION ALL SELECT o_orderkey, 2, 'rdap', CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT' THEN c_nationkey END,
      o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT' FROM orders JOIN customer ON c_custkey = o_custkey
      WHERE o_orderstatus <> 'P' OR o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED'))
  SELECT 'd' || k || '.com' AS domain, CAST(seq AS BIGINT) AS seq, 'com' AS tld, by_ AS modified_by, reg AS registered,
    CAST(last_value(rid IGNORE NULLS) OVER (PARTITION BY k ORDER BY seq) AS BIGINT) AS registrar_id, true AS has_whois, seq = 2 AS has_rdap FROM u""")
def _(spark, sf):
    """Text and RDAP captures of the same names through their extractors, the wire and the merge. An RDAP result stamps both times."""
    at = F.lit("2024-03-05 00:00:00").cast("timestamp")
    raw = [extractors.extractor("whois")(whois_captures(spark, sf), _segment_ids(spark, sf)), extractors.extractor("rdap")(rdap_captures(spark, sf))]
    sent = [merge.encode_updates(merge.as_updates(up, F.lit(n + 1), at)).select(F.lit(n + 1).cast("bigint").alias("seq"), "key", "value", at.alias("arrived"))
            for n, up in enumerate(raw)]
    updates, _bad = merge.decode_updates(sent[0].unionByName(sent[1]))
    rows, _rejected = merge.apply_updates(updates.select(*schema.TABLE_COLS).limit(0), updates, shaped.suffixes(spark))
    return rows.select("domain", "seq", "tld", "modified_by", "registered", "registrar_id", F.col("whois_scraped").isNotNull().alias("has_whois"),
                       F.col("rdap_scraped").isNotNull().alias("has_rdap"))


@query("json_event_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# --- DNS answers and addresses ---------------------------------------------------------------------
def dns_answers(spark, sf):
    """Line items as DNS answers of their customer's name."""
    li = spread_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    r = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    host = F.format_string("NS%d.Supplier-%09d.net.", F.col("l_linenumber"), F.col("l_suppkey"))
    kind = F.when(flag == "A", "A").when(flag == "N", "NS").when(F.col("l_linestatus") == "F", "MX").otherwise("TXT")
    rdata = F.when(flag == "A", address()).when(flag == "N", host).when(F.col("l_linestatus") == "F", F.concat(F.lit("mx."), host)).otherwise(
        F.format_string("v=spf%d", F.col("l_partkey")))
    return r.select(F.format_string("C%d.com", F.col("o_custkey")).alias("domain"), kind.alias("rrtype"),
                    F.when(flag == "N", "AUTHORITY").otherwise("ANSWER").alias("section"), rdata.alias("rdata"), F.lit("NOERROR").alias("rcode"))


def _octets(key: str):
    """A part key as the first three octets of an address, from 20.0.0 on; there is room for 15 million parts."""
    k = F.col(key)
    return (F.floor(k / 65536) + 20).cast("int"), F.pmod(F.floor(k / 256), F.lit(256)).cast("int"), F.pmod(k, F.lit(256)).cast("int")


def address():
    return F.format_string("%d.%d.%d.%d", *_octets("l_partkey"), F.col("l_linenumber"))


_DNS_SQL = """ans AS (SELECT 'c' || o_custkey || '.com' AS domain, l_returnflag AS f, l_linestatus AS s,
  printf('ns%d.supplier-%09d.net', l_linenumber, l_suppkey) AS host, printf('supplier-%09d.net', l_suppkey) AS hd,
  printf('%d.%d.%d.%d', 20 + l_partkey // 65536, (l_partkey // 256) % 256, l_partkey % 256, l_linenumber) AS ip, 'v=spf' || l_partkey AS txt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("normalise_dns", f"""WITH {_DNS_SQL} SELECT domain, coalesce(string_agg(ip, ',' ORDER BY ip) FILTER (f = 'A'), '') AS addr,
  coalesce(string_agg(host, ',' ORDER BY host) FILTER (f = 'N'), '') AS ns, coalesce(string_agg('mx.' || host, ',' ORDER BY host) FILTER (f = 'R' AND s = 'F'), '') AS mx,
  coalesce(string_agg(txt, ',' ORDER BY txt) FILTER (f = 'R' AND s <> 'F'), '') AS txt,
  array_to_string(list_sort(coalesce(list(DISTINCT hd) FILTER (f = 'N'), [])), ',') AS ns_domains,
  count(*) FILTER (f = 'N') > 0 AS dns_exists, CASE WHEN count(*) FILTER (f = 'A') > 0 THEN 'NOERROR' ELSE '' END AS rcode FROM ans GROUP BY domain""")
def _(spark, sf):
    d = extract_dns.normalise_dns(dns_answers(spark, sf), shaped.suffixes(spark))
    return d.select("domain", *[text.list_text(F.col(c)).alias(c) for c in ("addr", "ns", "mx", "txt", "ns_domains")], "dns_exists", "rcode")


def networks(spark, sf):
    """Networks from parts and suppliers, nested in each other: /24, some /28 and /16."""
    p = table(spark, sf, "part")
    cc = F.concat(F.lit("C"), F.col("p_size").cast("string"))
    network = F.format_string("%d.%d.%d.0", *_octets("p_partkey")).alias("network")
    wide = p.where(F.col("p_type") != "PROMO").select(network, F.lit(24).alias("prefix_len"), cc.alias("country_code"))
    narrow = p.where(F.col("p_type") == "SMALL").select(network, F.lit(30).alias("prefix_len"), F.concat(F.lit("N"), cc).alias("country_code"))
    s = table(spark, sf, "supplier").withColumn("_first", F.col("s_suppkey") * 256)
    big = s.where(F.col("s_acctbal") > 3000).select(F.format_string("%d.%d.%d.0", *_octets("_first")).alias("network"), F.lit(16).alias("prefix_len"),
                                                   F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("country_code"))
    return wide.unionByName(narrow).unionByName(big)


_GEO_SQL = f"""{_DNS_SQL}, li AS (SELECT DISTINCT 'c' || o_custkey || '.com' AS domain, l_partkey, l_linenumber FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'),
  hit AS (SELECT domain, CASE WHEN p_type = 'SMALL' AND l_linenumber < 4 THEN 'NC' || p_size WHEN p_type <> 'PROMO' THEN 'C' || p_size
    WHEN s_acctbal > 3000 THEN 'S' || s_suppkey END AS geo FROM li JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_partkey // 256)"""


@query("geo_lookup", f"""WITH {_GEO_SQL} SELECT domain, array_to_string(list_sort(coalesce(list(DISTINCT geo) FILTER (geo IS NOT NULL), [])), ',') AS geo
  FROM hit GROUP BY domain""")
def _(spark, sf):
    a = dns_answers(spark, sf).where(F.col("rrtype") == "A")
    rows = a.groupBy(F.lower("domain").alias("domain")).agg(F.collect_set("rdata").alias("addr"))
    found = enrich.lookup_lists(rows, ["domain"], {"geo": (networks(spark, sf), "country_code")})
    return found.withColumn("geo", text.list_text(F.col("geo")))


@query("add_geo_asn", f"""WITH {_GEO_SQL}, g AS (SELECT domain, array_to_string(list_sort(coalesce(list(DISTINCT geo) FILTER (geo IS NOT NULL), [])), ',') AS geo
    FROM hit GROUP BY domain)
  SELECT a.domain, coalesce(g.geo, '') AS geo, coalesce(g.geo, '') AS asn, g.domain IS NOT NULL AS carried FROM (SELECT DISTINCT domain FROM ans) a
  LEFT JOIN g ON g.domain = a.domain""")
def _(spark, sf):
    d = extract_dns.normalise_dns(dns_answers(spark, sf), shaped.suffixes(spark))
    none = F.array().cast("array<string>")
    up = d.withColumn("seq", F.xxhash64("domain")).withColumn("fields", F.array(F.lit("addr"))).withColumn("geo", none).withColumn("asn", none)
    net = networks(spark, sf)
    out = enrich.add_geo_asn(up, net, net.withColumnRenamed("country_code", "asn"))
    return out.select("domain", text.list_text(F.col("geo")).alias("geo"), text.list_text(F.col("asn")).alias("asn"),
                      F.array_contains("fields", "geo").alias("carried"))


@query("dns_into_rows", f"""WITH {_GEO_SQL}, g AS (SELECT domain, array_to_string(list_sort(coalesce(list(DISTINCT geo) FILTER (geo IS NOT NULL), [])), ',') AS geo
    FROM hit GROUP BY domain)
  SELECT a.domain, 'com' AS tld, 'dns' AS modified_by, coalesce(string_agg(ip, ',' ORDER BY ip) FILTER (f = 'A'), '') AS addr,
    coalesce(string_agg(host, ',' ORDER BY host) FILTER (f = 'N'), '') AS ns, coalesce(any_value(g.geo), '') AS geo, coalesce(any_value(g.geo), '') AS asn,
    count(*) FILTER (f = 'N') > 0 AS dns_exists FROM ans a LEFT JOIN g ON g.domain = a.domain GROUP BY a.domain""")
def _(spark, sf):
    """DNS answers through their extractor, the address lookups and the merge."""
    s, net = shaped.suffixes(spark), networks(spark, sf)
    up = merge.as_updates(extractors.extractor("dns")(dns_answers(spark, sf), s), F.lit(1), F.lit("2024-03-05 00:00:00").cast("timestamp"))
    rows, _rejected = merge.apply_updates(up.select(*schema.TABLE_COLS).limit(0), up, s,
                                          enrich=lambda u: enrich.add_geo_asn(u, net, net.withColumnRenamed("country_code", "asn")))
    return rows.select("domain", "tld", "modified_by", *[text.list_text(F.col(c)).alias(c) for c in ("addr", "ns", "geo", "asn")], "dns_exists")
