"""Registered queries: reports, errors, rates. Each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.operators import reports
from zonewright.plans import jobs, shaped
from zonewright.plans.shaped import (AS_OF_EVENTS, AS_OF_ORDERS, ERRORS_SQL, LOG_SQL, SERVERS_SQL, current,
                                     current_with_servers, event_errors, supplier_domains, table)

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def _bands(col: str) -> str:
    t = f"TIMESTAMP '{AS_OF_ORDERS}'"

    def ago(days: int) -> str:
        return f"{t} - INTERVAL {days} DAY"

    conds = {"never": f"{col} IS NULL", "gt_90": f"{col} < {ago(90)}",
             "60_90": f"{col} BETWEEN {ago(90)} AND {ago(60)}", "30_60": f"{col} BETWEEN {ago(60)} AND {ago(30)}",
             "30_7": f"{col} BETWEEN {ago(30)} AND {ago(7)}", "lt_7": f"{col} > {ago(7)}"}
    return ", ".join(f"count(*) FILTER ({c}) AS {col}_{n}" for n, c in conds.items())


@query("scrape_age_report", f"WITH {LOG_SQL} SELECT {_bands('dns_scraped')}, {_bands('whois_scraped')} FROM cur")
def _(spark, sf):
    return reports.scrape_age_report(current(spark, sf, "dns_scraped", "whois_scraped"), AS_OF_ORDERS)


@query("scraped_last_day", f"""WITH {LOG_SQL} SELECT count(*) FILTER (dns_scraped > TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 1 DAY)
  AS count FROM cur""")
def _(spark, sf):
    return reports.scraped_last_day(current(spark, sf, "dns_scraped"), AS_OF_ORDERS)


@query("ns_domain_report", f"""WITH {LOG_SQL}, {SERVERS_SQL},
  free AS (SELECT printf('supplier-%09d.net', s_suppkey) AS domain FROM supplier WHERE s_acctbal < 0)
  SELECT ns, count(*) AS count FROM (SELECT unnest(ns_domains) AS ns FROM curns) JOIN free ON ns = free.domain
  GROUP BY ns HAVING count(*) > 1""")
def _(spark, sf):
    cur = current_with_servers(spark, sf, "registered").select("domain", "registered", "ns_domains")
    hosts = supplier_domains(spark, sf).withColumn("ns_domains", F.array().cast("array<string>"))
    return reports.ns_domain_report(cur.unionByName(hosts))


@query("recent_errors", f"""WITH {ERRORS_SQL}, r AS (SELECT * FROM errors WHERE timestamp > TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 3 DAY)
  SELECT array_to_string(list(uuid ORDER BY timestamp, uuid)[1:10], ',') AS uuids, error_type, file, line, scraper, topic,
  array_to_string(list(domain ORDER BY timestamp, uuid)[1:10], ',') AS domains, count(*) AS count, max(timestamp) AS latest
  FROM r GROUP BY error_type, file, line, scraper, topic""")
def _(spark, sf):
    found = reports.recent_errors(event_errors(spark, sf), AS_OF_EVENTS)
    return found.withColumn("uuids", F.array_join("uuids", ",")).withColumn("domains", F.array_join("domains", ","))


@query("recent_errors_whole_log", f"""WITH {ERRORS_SQL} SELECT array_to_string(list(uuid ORDER BY timestamp, uuid)[1:10], ',')
  AS uuids, error_type, file, line, scraper, topic,
  array_to_string(list(domain ORDER BY timestamp, uuid)[1:10], ',') AS domains, count(*) AS count, max(timestamp) AS latest
  FROM errors GROUP BY error_type, file, line, scraper, topic""")
def _(spark, sf):
    found = reports.recent_errors(event_errors(spark, sf), days=None)
    return found.withColumn("uuids", F.array_join("uuids", ",")).withColumn("domains", F.array_join("domains", ","))


@query("latest_errors", f"""WITH {ERRORS_SQL} SELECT uuid, error_type, error, file, line, scraper, domain, timestamp
  FROM errors ORDER BY timestamp DESC, uuid LIMIT 100""")
def _(spark, sf):
    return reports.latest_errors(event_errors(spark, sf))


@query("error_details", f"""WITH {ERRORS_SQL} SELECT domain, error, error_type, file, line, scraper, topic, timestamp, traceback,
  uuid FROM errors WHERE uuid = '00000000-0000-4000-8000-000000000042'""")
def _(spark, sf):
    return reports.error_details(event_errors(spark, sf), "00000000-0000-4000-8000-000000000042")


_FAILED = f"""failed AS (SELECT DISTINCT domain, scraper FROM errors WHERE timestamp >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 1 DAY
  AND error_type IN ('SSLError', 'ProxyError', 'ReadTimeout', 'HTTPError'))"""


@query("failed_scrapes", f"WITH {ERRORS_SQL}, {_FAILED} SELECT domain, scraper FROM failed")
def _(spark, sf):
    return reports.failed_scrapes(event_errors(spark, sf), AS_OF_EVENTS)


@query("queue_failed", f"""WITH {ERRORS_SQL}, {_FAILED} SELECT 'scrape.' || CASE WHEN scraper = 'whois' THEN 'rdap' ELSE scraper END
  AS topic, domain AS key, '{{}}' AS value FROM failed""")
def _(spark, sf):
    return jobs.queue_failed(event_errors(spark, sf), shaped.suffixes(spark), AS_OF_EVENTS)


_RATE = """WITH c AS (SELECT {target} AS target, CAST(floor(epoch({ts}) / {unit}) AS BIGINT) AS slot, count(*) AS n
  FROM {rows} GROUP BY ALL)
  SELECT a.target, to_timestamp(a.slot * {unit}) AT TIME ZONE 'UTC' AS window_start, a.n AS cur_count, coalesce(b.n, 0) AS prev_count,
  coalesce(b.n, 0) * 0.75::DOUBLE + a.n AS load, coalesce(b.n, 0) * 0.75::DOUBLE + a.n > {cap} AS over_limit
  FROM c a LEFT JOIN c b ON a.target = b.target AND a.slot = b.slot + 1"""


@query("request_rate", _RATE.format(target="event_type", ts="ts", unit=3600, rows="events", cap=4))
def _(spark, sf):
    out = reports.request_rate(table(spark, sf, "events"), "event_type", "ts", 4, unit_seconds=3600, at=0.25)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("request_rate_per_user", _RATE.format(target="user_id", ts="ts", unit=86400, rows="events", cap=3))
def _(spark, sf):
    out = reports.request_rate(table(spark, sf, "events"), "user_id", "ts", 3, unit_seconds=86400, at=0.25)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
