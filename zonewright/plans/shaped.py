"""Warehouse tables seen as domain data: Spark frames and, beside each, the same in ANSI SQL.

Orders are versions of their customer's domain, line items its nameservers, DNS answers and zone
lines, events its partial updates, errors and requests, pages the hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.operators.names import Suffixes
from zonewright.operators.skew import spread_scan

AS_OF_ORDERS = "2001-06-15 00:00:00"
AS_OF_EVENTS = "2024-01-31 00:00:00"

SUFFIXES = ["com", "net", "org", "au", "uk", "com.au", "co.uk", "example.com", "example.net"]
_TLD = {"BUILDING": "com", "AUTOMOBILE": "net", "MACHINERY": "org", "HOUSEHOLD": "com.au", "FURNITURE": "co.uk"}
_SOURCE = {"1-URGENT": "zonefile", "2-HIGH": "dns", "3-MEDIUM": "rdap", "4-NOT SPECIFIED": "pi", "5-LOW": "whois"}
_ERROR = {"view": "ProxyError", "click": "SSLError", "purchase": "ReadTimeout", "signup": "ValueError",
          "error": "HTTPError"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    """For costly work per row: columns of a table, dealt out if it comes in fewer splits than cores."""
    t = table(spark, sf, name)
    return spread_scan(t.select(*cols) if cols else t)


def suffixes(spark: SparkSession) -> Suffixes:
    return Suffixes.of(spark, SUFFIXES)


def _mapped(col: str, pairs: dict[str, str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in pairs.items():
        out = out.when(F.col(col) == k, F.lit(v))
    return out


def _mapped_sql(col: str, pairs: dict[str, str]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def customer_domain() -> Column:
    return F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))), F.lit("."), _mapped("c_mktsegment", _TLD))


CUSTOMER_DOMAIN_SQL = f"lower(replace(c_name, '#', '-')) || '.' || {_mapped_sql('c_mktsegment', _TLD)}"


# --- version log -------------------------------------------------------------------------------
def domain_log(spark: SparkSession, sf: str) -> DataFrame:
    """One version per order."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    real = _mapped("c_mktsegment", _TLD)
    stored = (F.when(F.col("o_orderstatus") == "P", F.substring_index(real, ".", -1))
              .when(F.col("o_orderpriority") == "5-LOW", "").otherwise(real))
    visits = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("seq"), customer_domain().alias("domain"), stored.alias("tld"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("registered"),
        _mapped("o_orderpriority", _SOURCE).alias("modified_by"), F.col("o_orderdate").alias("last_modified"),
        visits.alias("visits_12m"), F.col("c_nationkey").cast("bigint").alias("registrar_id"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("user-"), F.col("c_nationkey"))).alias("pm_username"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")).alias("dns_scraped"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("whois_scraped"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("ok")))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit("clientHold"), F.lit("pendingDelete")))
        .otherwise(F.array().cast("array<string>")).alias("status"),
        F.transform(F.sequence(F.lit(1), F.lit(12)),
                    lambda m: F.when(m == F.month("o_orderdate"), visits).otherwise(0)).alias("visits_arr_12m"))


LOG_SQL = f"""log AS (
  SELECT o_orderkey AS seq, {CUSTOMER_DOMAIN_SQL} AS domain,
    CASE WHEN o_orderstatus = 'P' THEN regexp_extract({_mapped_sql('c_mktsegment', _TLD)}, '[a-z]+$')
         WHEN o_orderpriority = '5-LOW' THEN '' ELSE {_mapped_sql('c_mktsegment', _TLD)} END AS tld,
    CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS registered,
    {_mapped_sql('o_orderpriority', _SOURCE)} AS modified_by, o_orderdate AS last_modified,
    CAST(round(o_totalprice * 100) AS BIGINT) AS visits_12m, CAST(c_nationkey AS BIGINT) AS registrar_id,
    CASE WHEN c_acctbal >= 0 THEN 'user-' || c_nationkey END AS pm_username,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS dns_scraped,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS whois_scraped,
    CASE o_orderstatus WHEN 'F' THEN ['ok'] WHEN 'O' THEN ['clientHold', 'pendingDelete']
         ELSE CAST([] AS VARCHAR[]) END AS status
  FROM orders JOIN customer ON c_custkey = o_custkey),
cur AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY domain ORDER BY last_modified DESC, seq DESC) = 1)"""


def current(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    from zonewright.operators.latest import latest_by_key
    return latest_by_key(domain_log(spark, sf), cols=list(cols) or None)


# --- nameservers -------------------------------------------------------------------------------
def server_name() -> Column:
    return F.format_string("ns%d.supplier-%09d.net", F.col("l_linenumber"), F.col("l_suppkey"))


def order_servers(spark: SparkSession, sf: str) -> DataFrame:
    """Per order the sorted servers and server domains of its line items."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return li.groupBy(F.col("l_orderkey").alias("seq")).agg(
        F.array_sort(F.collect_set(server_name())).alias("ns"),
        F.array_sort(F.collect_set(F.format_string("supplier-%09d.net", F.col("l_suppkey")))).alias("ns_domains"))


def current_with_servers(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Latest versions with `ns` and `ns_domains`; the version is chosen before the lists are fetched."""
    cur = current(spark, sf, "seq", *cols)
    found = cur.join(order_servers(spark, sf), "seq", "left")
    none = F.array().cast("array<string>")
    return found.withColumn("ns", F.coalesce("ns", none)).withColumn("ns_domains", F.coalesce("ns_domains", none))


SERVERS_SQL = """srv AS (
  SELECT l_orderkey AS seq, list_sort(list(DISTINCT printf('ns%d.supplier-%09d.net', l_linenumber, l_suppkey))) AS ns,
    list_sort(list(DISTINCT printf('supplier-%09d.net', l_suppkey))) AS ns_domains
  FROM lineitem GROUP BY l_orderkey),
curns AS (SELECT cur.*, coalesce(srv.ns, []) AS ns, coalesce(srv.ns_domains, []) AS ns_domains
          FROM cur LEFT JOIN srv ON srv.seq = cur.seq)"""


def supplier_domains(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(F.format_string("supplier-%09d.net", F.col("s_suppkey")).alias("domain"),
                    (F.col("s_acctbal") >= 0).alias("registered"))


# --- events --------------------------------------------------------------------------------
def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def event_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Events as typed partial updates; which columns one carries follows from its type."""
    e = table(spark, sf, "events").withColumn("k", _k())
    kind = F.col("event_type")
    both = [F.lit("modified_by"), F.lit("last_modified")]

    def carries(*names: str) -> Column:
        return F.array(*[F.lit(n) for n in names], *both)

    return e.select(
        F.col("event_id").alias("seq"), F.format_string("u%d.com", F.col("user_id")).alias("domain"),
        F.when(kind == "view", "PIResult").when(kind == "click", "ZonefileResult").when(kind == "signup", "RDAPResult")
        .when(kind == "error", "RDAPNXResult").otherwise("DNSResult").alias("type"),
        F.when(kind == "view", carries("visits_12m", "hits_12m", "hits_geo")).when(kind == "click", carries("tld", "ns"))
        .when(kind == "signup", carries("registered", "registrar_id", "registrant_name"))
        .when(kind == "error", carries("registered")).otherwise(carries("dns_exists", "rcode")).alias("fields"),
        F.round(F.col("value") * 100).cast("bigint").alias("visits_12m"), F.col("k").alias("hits_12m"),
        F.concat(F.lit("geo"), F.col("k")).alias("hits_geo"), F.lit("com").alias("tld"),
        F.array(F.concat(F.lit("ns"), F.col("k"), F.lit(".example.net"))).alias("ns"),
        (kind == "signup").alias("registered"), F.col("k").alias("registrar_id"),
        F.when(F.col("k") >= 50, F.concat(F.lit("n"), F.col("k"))).alias("registrant_name"),
        (F.col("k") >= 50).alias("dns_exists"), F.when(F.col("k") >= 50, "NOERROR").otherwise("NXDOMAIN").alias("rcode"),
        F.when(kind == "view", "pi").when(kind == "click", "zonefile").when(kind == "purchase", "dns")
        .otherwise("rdap").alias("modified_by"), F.col("ts").alias("last_modified"))


UPDATES_SQL = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
upd AS (SELECT event_id AS seq, 'u' || user_id || '.com' AS domain, event_type, ts AS last_modified, k,
  CASE event_type WHEN 'view' THEN 'pi' WHEN 'click' THEN 'zonefile' WHEN 'purchase' THEN 'dns' ELSE 'rdap' END AS modified_by,
  CASE WHEN event_type = 'view' THEN {'v': CAST(round(value * 100) AS BIGINT)} END AS visits_12m,
  CASE WHEN event_type = 'view' THEN {'v': 'geo' || k} END AS hits_geo,
  CASE WHEN event_type = 'click' THEN {'v': 'ns' || k || '.example.net'} END AS ns,
  CASE WHEN event_type = 'click' THEN {'v': 'com'} END AS tld,
  CASE WHEN event_type IN ('signup', 'error') THEN {'v': event_type = 'signup'} END AS registered,
  CASE WHEN event_type = 'signup' THEN {'v': k} END AS registrar_id,
  CASE WHEN event_type = 'signup' THEN {'v': CASE WHEN k >= 50 THEN 'n' || k END} END AS registrant_name,
  CASE WHEN event_type = 'purchase' THEN {'v': CASE WHEN k >= 50 THEN 'NOERROR' ELSE 'NXDOMAIN' END} END AS rcode
  FROM ev)"""


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as full versions of the user's domain."""
    e = table(spark, sf, "events").withColumn("k", _k())
    return e.select(F.col("event_id").alias("seq"), F.format_string("u%d.com", F.col("user_id")).alias("domain"),
                    F.col("ts").alias("last_modified"), F.col("event_type").alias("modified_by"),
                    F.floor(F.col("value") / 20).cast("bigint").alias("visits_12m"),
                    F.when(F.col("k") >= 30, F.floor(F.col("k") / 25)).cast("bigint").alias("registrar_id"),
                    F.array(F.concat(F.lit("ns"), F.floor(F.col("k") / 40))).alias("ns"))


EVENT_LOG_SQL = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
elog AS (SELECT event_id AS seq, 'u' || user_id || '.com' AS domain, ts AS last_modified, event_type AS modified_by,
  CAST(floor(value / 20) AS BIGINT) AS visits_12m, CASE WHEN k >= 30 THEN k // 25 END AS registrar_id,
  '["ns' || (k // 40) || '"]' AS ns FROM ev)"""


def event_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scrape errors."""
    e = table(spark, sf, "events").withColumn("k", _k())
    scraper = F.when(F.col("k") < 40, "dns").when(F.col("k") < 80, "rdap").otherwise("whois")
    return e.select(F.format_string("00000000-0000-4000-8000-%012d", F.col("event_id")).alias("uuid"),
                    F.format_string("u%d.com", F.col("user_id")).alias("domain"),
                    F.concat(F.lit("failed with "), F.col("event_type")).alias("error"),
                    _mapped("event_type", _ERROR).alias("error_type"), F.concat(scraper, F.lit(".py")).alias("file"),
                    F.floor(F.col("k") / 20).cast("int").alias("line"), F.lit("").alias("traceback"),
                    scraper.alias("scraper"),
                    F.when(F.col("k") >= 10, F.concat(F.lit("scrape."), scraper)).alias("topic"),
                    F.col("ts").alias("timestamp"))


ERRORS_SQL = f"""er0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
er AS (SELECT printf('00000000-0000-4000-8000-%012d', event_id) AS uuid, 'u' || user_id || '.com' AS domain,
  'failed with ' || event_type AS error, {_mapped_sql('event_type', _ERROR)} AS error_type,
  CASE WHEN k < 40 THEN 'dns' WHEN k < 80 THEN 'rdap' ELSE 'whois' END AS scraper,
  CAST(k // 20 AS INTEGER) AS line, ts AS timestamp, k FROM er0),
errors AS (SELECT *, scraper || '.py' AS file, CASE WHEN k >= 10 THEN 'scrape.' || scraper END AS topic,
  '' AS traceback FROM er)"""


# --- hosts of pages -----------------------------------------------------------------------------
def page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"))


HOSTS_SQL = f"""hosts AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages),
sfx AS (SELECT unnest({SUFFIXES}) AS suffix)"""


def suffix_sql(rows: str, host: str, keep: str) -> str:
    """CTE body: `keep` columns plus the longest suffix after a dot in `host`."""
    return (f"SELECT {keep}, {host} AS host, arg_max(suffix, length(suffix)) AS suffix FROM {rows} "
            f"LEFT JOIN sfx ON ends_with({host}, '.' || suffix) GROUP BY ALL")


NORMALIZED_SQL = ("CASE WHEN suffix IS NOT NULL THEN array_to_string(list_slice(string_split(host, '.'), "
                  "-(len(string_split(suffix, '.')) + 1), -1), '.') END")
