"""Registered queries: partial updates, history, snapshots, zone imports, streams. Each with its SQL counterpart."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonewright import schema
from zonewright.operators import history, merge, skew, snapshots
from zonewright.plans import jobs, shaped
from zonewright.plans.shaped import (EVENT_LOG_SQL, LOG_SQL, UPDATES_SQL, event_errors, event_log,
                                     event_updates, spread_table, table)
from zonewright.session import shared_dir
from zonewright.sources import messages, zone

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


# --- fold and merge ------------------------------------------------------------------------------
_FOLDED = ["visits_12m", "hits_geo", "tld", "registered", "registrar_id", "registrant_name", "rcode"]


def _running(cols: list[str], rows: str) -> str:
    over = "OVER (PARTITION BY domain ORDER BY seq ROWS UNBOUNDED PRECEDING)"
    return f"SELECT seq, domain, {', '.join(f'last_value({c} IGNORE NULLS) {over} AS {c}' for c in cols)} FROM {rows}"


@query("fold_updates", f"""WITH {UPDATES_SQL}, f AS ({_running(_FOLDED, 'upd')})
  SELECT seq, domain, {', '.join(f"{c}.v AS {c}, {c} IS NOT NULL AS has_{c}" for c in _FOLDED)} FROM f""")
def _(spark, sf):
    folded = merge.fold_updates(event_updates(spark, sf), _FOLDED)
    return folded.select("seq", "domain", *[F.col(c)["c"].alias(c) for c in _FOLDED],
                         *[F.col(c).isNotNull().alias(f"has_{c}") for c in _FOLDED])


def _stored(spark, sf):
    """Stored rows for the users' names, one per customer key."""
    c = table(spark, sf, "customer")
    return c.select(F.format_string("u%d.com", F.col("c_custkey")).alias("domain"),
                    F.when(F.col("c_acctbal") >= 0, "com").otherwise("").alias("tld"),
                    F.lit(None).cast("boolean").alias("registered"), F.col("c_nationkey").cast("bigint").alias("registrar_id"),
                    F.col("c_name").alias("registrant_name"), F.lit("").alias("rcode"), F.lit("").alias("hits_geo"),
                    F.round(F.col("c_acctbal") * 100).cast("bigint").alias("visits_12m"))


@query("merge_updates", f"""WITH {UPDATES_SQL},
  stored AS (SELECT CAST(-1 AS BIGINT) AS seq, 'u' || c_custkey || '.com' AS domain,
    {{'v': CAST(round(c_acctbal * 100) AS BIGINT)}} AS visits_12m, {{'v': ''}} AS hits_geo,
    {{'v': CASE WHEN c_acctbal >= 0 THEN 'com' ELSE '' END}} AS tld, {{'v': CAST(NULL AS BOOLEAN)}} AS registered,
    {{'v': CAST(c_nationkey AS BIGINT)}} AS registrar_id, {{'v': c_name}} AS registrant_name, {{'v': ''}} AS rcode
    FROM customer),
  rows_ AS (SELECT seq, domain, {', '.join(_FOLDED)} FROM upd UNION ALL SELECT seq, domain, {', '.join(_FOLDED)} FROM stored),
  f AS ({_running(_FOLDED, 'rows_')})
  SELECT seq, domain, coalesce(visits_12m.v, NULL) AS visits_12m, CASE WHEN hits_geo IS NULL THEN '' ELSE hits_geo.v END AS hits_geo,
  CASE WHEN tld IS NULL THEN '' ELSE tld.v END AS tld, registered.v AS registered, registrar_id.v AS registrar_id,
  registrant_name.v AS registrant_name, CASE WHEN rcode IS NULL THEN '' ELSE rcode.v END AS rcode FROM f WHERE seq >= 0""")
def _(spark, sf):
    return merge.merge_updates(_stored(spark, sf), event_updates(spark, sf), cols=_FOLDED)


@query("merge_into_empty", f"""WITH {UPDATES_SQL}, f AS ({_running(_FOLDED, 'upd')})
  SELECT seq, domain, visits_12m.v AS visits_12m, CASE WHEN hits_geo IS NULL THEN '' ELSE hits_geo.v END AS hits_geo,
  CASE WHEN tld IS NULL THEN '' ELSE tld.v END AS tld, registered.v AS registered, registrar_id.v AS registrar_id,
  registrant_name.v AS registrant_name, CASE WHEN rcode IS NULL THEN '' ELSE rcode.v END AS rcode FROM f""")
def _(spark, sf):
    empty = _stored(spark, sf).where(F.lit(False))
    return merge.merge_updates(empty, event_updates(spark, sf), cols=_FOLDED)


@query("registered_by_resolution", f"""WITH {UPDATES_SQL} SELECT seq, domain,
  CASE WHEN modified_by = 'dns' AND k >= 50 THEN true ELSE coalesce(registered.v, false) END AS registered,
  modified_by = 'dns' AND k >= 50 OR registered IS NOT NULL AS carried FROM upd""")
def _(spark, sf):
    ruled = merge.registered_by_resolution(event_updates(spark, sf))
    return ruled.select("seq", "domain", "registered", F.array_contains("fields", "registered").alias("carried"))


_NX_MESSAGES = """msgs AS (SELECT event_id AS seq, event_type, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, ts
  FROM events)"""


def event_messages(spark, sf):
    """Events as result messages on the wire; some types and values are not valid."""
    e = spread_table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    kind = F.col("event_type")
    name = F.format_string("U%d.COM", F.col("user_id"))
    value = (F.when(kind == "view", F.format_string(
        '{"type":"PIResult","domain":"x","visits_12m":"%d","hits_12m":%d,"visits_arr_12m":[1,2,3],'
        '"last_visit_date":"2024-01-01","hits_geo":"AU","pi_rank":7}', F.col("k"), F.col("k")))
        .when(kind == "click", F.format_string(
            '{"type":"ZonefileResult","domain":"x","ns":["NS1.Example.NET","ns%d.example.net"],"ns_domains":["example.net"],'
            '"tld":"COM","zonefile_date":"2024-01-%02d"}', F.col("k"), F.col("k") % 40))
        .when(kind == "signup", F.format_string('{"type":"RDAPNXResult","domain":"x","registered":%s}',
                                                F.when(F.col("k") < 20, "null").when(F.col("k") < 40, '"maybe"').otherwise("false")))
        .when(kind == "purchase", F.format_string('{"type":"OwnershipResult","domain":"x"%s}',
                                                  F.when(F.col("k") < 50, ',"pm_username":null').otherwise("")))
        .otherwise(F.format_string('{"type":"Kind%d"}', F.col("k"))))
    return e.select(F.col("event_id").alias("seq"), name.alias("key"), value.alias("value"),
                    F.col("ts").cast("timestamp").alias("arrived"))


_REASON = """CASE WHEN event_type = 'error' THEN 'unknown type'
  WHEN event_type = 'click' AND (k % 40 = 0 OR k % 40 > 31) THEN 'bad zonefile_date'
  WHEN event_type = 'signup' AND k < 20 THEN 'null registered'
  WHEN event_type = 'signup' AND k < 40 THEN 'bad registered'
  WHEN event_type = 'purchase' AND k >= 50 THEN 'missing pm_username' END"""


@query("decode_updates_valid", f"""WITH {_NX_MESSAGES}, j AS (SELECT *, {_REASON} AS reason FROM msgs)
  SELECT seq, 'u' || user_id || '.com' AS domain,
  CASE event_type WHEN 'view' THEN 'PIResult' WHEN 'click' THEN 'ZonefileResult' WHEN 'signup' THEN 'RDAPNXResult'
    ELSE 'OwnershipResult' END AS type,
  CASE event_type WHEN 'view' THEN 'pi' WHEN 'click' THEN 'zonefile' WHEN 'signup' THEN 'rdap' ELSE 'ownership' END AS modified_by,
  CASE WHEN event_type = 'view' THEN k END AS visits_12m, CASE WHEN event_type = 'click' THEN 'com' END AS tld,
  CASE WHEN event_type = 'click' THEN 'ns1.example.net,ns' || k || '.example.net' END AS ns,
  CASE WHEN event_type = 'click' THEN CAST('2024-01-01' AS DATE) + CAST(k % 40 - 1 AS INTEGER) END AS zonefile_date,
  CASE WHEN event_type = 'signup' THEN false END AS registered FROM j WHERE reason IS NULL""")
def _(spark, sf):
    good, _bad = merge.decode_updates(event_messages(spark, sf))
    click = F.col("type") == "ZonefileResult"
    return good.select("seq", "domain", "type", "modified_by", "visits_12m", "tld", F.array_join("ns", ",").alias("ns"),
                       F.when(click, F.col("zonefile_date")).alias("zonefile_date"), "registered")


@query("decode_updates_quarantine", f"""WITH {_NX_MESSAGES}, j AS (SELECT *, {_REASON} AS reason FROM msgs)
  SELECT seq, 'U' || user_id || '.COM' AS key, reason FROM j WHERE reason IS NOT NULL""")
def _(spark, sf):
    return merge.decode_updates(event_messages(spark, sf))[1].select("seq", "key", "reason")


@query("encode_round_trip", f"""WITH {UPDATES_SQL} SELECT seq, domain, registrar_id IS NOT NULL AS has_id, registrar_id.v AS registrar_id,
  registrant_name.v AS registrant_name, ns.v AS ns, tld.v AS tld, registered.v AS registered, rcode.v AS rcode, visits_12m.v AS visits_12m,
  hits_geo.v AS hits_geo, modified_by FROM upd""")
def _(spark, sf):
    sent = event_updates(spark, sf)
    wire = merge.encode_updates(sent.withColumn("last_modified", F.col("last_modified").cast("timestamp"))
                                .withColumn("pi_rank", F.col("seq")).withColumn("fields", F.array_append("fields", "pi_rank")))
    back = F.from_json("value", "pi_rank bigint, registrar_id bigint, registrant_name string, ns array<string>, tld string, registered boolean, "
                                "rcode string, visits_12m bigint, hits_geo string, modified_by string")
    read = wire.select("key", "value", back.alias("b"))
    return read.select(F.col("b.pi_rank").alias("seq"), F.col("key").alias("domain"), F.contains(F.col("value"), F.lit('"registrar_id":')).alias("has_id"),
                       F.array_join("b.ns", ",").alias("ns"),
                       *[f"b.{c}" for c in ("registrar_id", "registrant_name", "tld", "registered", "rcode", "visits_12m", "hits_geo", "modified_by")])


# --- history -------------------------------------------------------------------------------------
_WATCHED = ["visits_12m", "registrar_id", "ns"]
_LAGGED = f"""lagged AS (SELECT *, row_number() OVER w = 1 AS is_first,
  {', '.join(f'lag({c}) OVER w AS p_{c}' for c in ['modified_by', *_WATCHED])}
  FROM elog WINDOW w AS (PARTITION BY domain ORDER BY last_modified, seq))"""


def _changed_sql(cols: list[str], before_first: str) -> str:
    return " UNION ALL ".join(
        f"SELECT seq, domain, last_modified, modified_by, is_first, '{c}' AS field, "
        f"CASE WHEN is_first THEN {before_first} ELSE CAST(p_{c} AS VARCHAR) END AS before, CAST({c} AS VARCHAR) AS after "
        f"FROM lagged WHERE is_first OR p_{c} IS DISTINCT FROM {c}" for c in cols)


@query("change_history", f"""WITH {EVENT_LOG_SQL}, {_LAGGED}, ch AS ({_changed_sql(_WATCHED, 'NULL')})
  SELECT seq, domain, last_modified, is_first, field, before, after FROM ch""")
def _(spark, sf):
    hist = history.change_history(event_log(spark, sf), _WATCHED)
    return hist.select("seq", "domain", "last_modified", "is_first", F.explode("changes").alias("c")).select(
        "seq", "domain", "last_modified", "is_first", "c.field", "c.before", "c.after")


@query("change_table", f"""WITH {EVENT_LOG_SQL}, {_LAGGED}, ch AS ({_changed_sql(['modified_by', *_WATCHED], "'N/A'")})
  SELECT seq, domain, last_modified, modified_by, field, before, after FROM ch""")
def _(spark, sf):
    return history.change_table(event_log(spark, sf), _WATCHED)


@query("domain_changes", f"""WITH {EVENT_LOG_SQL}, {_LAGGED}, ch AS ({_changed_sql(['modified_by', *_WATCHED], "'N/A'")})
  SELECT seq, domain, last_modified, modified_by, field, before, after FROM ch WHERE domain = 'u3.com'""")
def _(spark, sf):
    return history.domain_changes(event_log(spark, sf), "u3.com", _WATCHED)


@query("arrival_number", """SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq
  FROM events""")
def _(spark, sf):
    return skew.arrival_number(table(spark, sf, "events").select("event_id", "user_id", "ts"), ["user_id"],
                               ["ts", "event_id"]).drop("ts")


@query("history_by_day", f"""WITH {EVENT_LOG_SQL} SELECT CAST(last_modified AS DATE) AS date, count(*) AS versions,
  count(DISTINCT domain) AS domains FROM elog GROUP BY date""")
def _(spark, sf):
    path = f"{_run_dir(spark)}/history"
    messages.append_history(event_log(spark, sf).select("domain", "last_modified"), path)
    return spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("versions"), F.countDistinct("domain").alias("domains"))


# --- zone text, snapshots and their difference -------------------------------------------------------
def zone_lines(spark, sf):
    """Line items as lines of zone text, in the forms zones come in: absolute, relative and upper case,
    with other record types in between; `prev` and `cur` tell which of two days a line is in."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = spread_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    r = li.join(o, li.l_orderkey == o.o_orderkey)
    owner = F.format_string("c%d", F.col("o_custkey"))
    host = F.format_string("ns%d.s%d", F.col("l_linenumber"), F.col("l_suppkey"))
    line = (F.when(F.col("l_returnflag") == "A", F.concat(owner, F.lit(".com. 3600 in ns "), host, F.lit(".net.")))
            .when(F.col("l_returnflag") == "N", F.concat(F.upper(owner), F.lit("\tNS\t"), F.upper(host)))
            .when(F.col("l_linestatus") == "F", F.concat(owner, F.lit(".com. 3600 in rrsig ns 8 2 3600 x")))
            .otherwise(F.concat(F.lit("com. 3600 in ns "), host, F.lit(".net."))))
    day = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("2024-03-01"))).when(
        F.col("o_orderstatus") == "O", F.array(F.lit("2024-03-03"))).otherwise(
        F.array(F.lit("2024-03-01"), F.lit("2024-03-03")))
    return r.select(line.alias("value"), F.lit("com").alias("tld"), F.explode(day.cast("array<date>")).alias("date"))


ZONE_SQL = """zl AS (SELECT 'c' || o_custkey || '.com' AS domain, l_returnflag AS f,
    'ns' || l_linenumber || '.s' || l_suppkey AS host,
    unnest(CASE o_orderstatus WHEN 'F' THEN [DATE '2024-03-01'] WHEN 'O' THEN [DATE '2024-03-03']
      ELSE [DATE '2024-03-01', DATE '2024-03-03'] END) AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rec AS (SELECT date, domain, CASE f WHEN 'A' THEN host || '.net' ELSE host || '.com' END AS ns FROM zl WHERE f IN ('A', 'N')),
snap AS (SELECT date, domain, list(ns ORDER BY ns) AS ns FROM rec GROUP BY date, domain),
prv AS (SELECT * FROM snap WHERE date = '2024-03-01'), now_ AS (SELECT * FROM snap WHERE date = '2024-03-03'),
chg AS (SELECT coalesce(n.domain, p.domain) AS domain, coalesce(n.ns, []) AS ns FROM prv p FULL JOIN now_ n ON p.domain = n.domain
  WHERE n.ns IS DISTINCT FROM p.ns)"""


def zone_records(spark, sf):
    lines = zone_lines(spark, sf).withColumn("zone", F.col("tld"))
    return zone.parse_zone_lines(lines, keep=["zone", "date"]).withColumnRenamed("zone", "tld")


@query("parse_zone_lines", f"WITH {ZONE_SQL} SELECT 'com' AS tld, date, domain, ns FROM rec")
def _(spark, sf):
    return zone_records(spark, sf)


@query("zone_snapshot", f"WITH {ZONE_SQL} SELECT 'com' AS tld, date, domain, array_to_string(ns, ',') AS ns FROM snap")
def _(spark, sf):
    snap = snapshots.zone_snapshot(zone_records(spark, sf), ["tld", "date"])
    return snap.withColumn("ns", F.array_join("ns", ","))


def _two_days(spark, sf):
    snap = snapshots.zone_snapshot(zone_records(spark, sf), ["date"])
    return [snap.where(F.col("date") == F.lit(d).cast("date")).drop("date") for d in ("2024-03-01", "2024-03-03")]


@query("diff_snapshots", f"WITH {ZONE_SQL} SELECT domain, array_to_string(ns, ',') AS ns FROM chg")
def _(spark, sf):
    return snapshots.diff_snapshots(*_two_days(spark, sf)).withColumn("ns", F.array_join("ns", ","))


@query("removed_keys", f"WITH {ZONE_SQL} SELECT domain FROM prv WHERE domain NOT IN (SELECT domain FROM now_)")
def _(spark, sf):
    return snapshots.removed_keys(*_two_days(spark, sf))


@query("change_count", f"WITH {ZONE_SQL} SELECT count(*) AS changes FROM chg")
def _(spark, sf):
    return snapshots.change_count(*_two_days(spark, sf))


def _file_listing(spark, sf):
    """One zone file name per order: nation as suffix, order day; some names do not fit."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    ext = F.when(F.col("o_orderstatus") == "P", ".txt").otherwise(".gz")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.concat(
        F.lit("file:/zones/zone-n"), F.col("c_nationkey"), F.lit("-"), F.date_format("o_orderdate", "yyyy-MM-dd"), ext)
        .alias("path")).distinct()


_FILES_SQL = """files AS (SELECT DISTINCT 'n' || c_nationkey AS tld, CAST(o_orderdate AS DATE) AS date,
  'file:/zones/zone-n' || c_nationkey || '-' || strftime(o_orderdate, '%Y-%m-%d') || '.gz' AS path
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')"""


@query("list_zone_files", f"WITH {_FILES_SQL} SELECT tld, date, path FROM files")
def _(spark, sf):
    return zone.zone_files(_file_listing(spark, sf))[0]


@query("previous_zone_file", f"""WITH {_FILES_SQL} SELECT a.tld, a.date, a.path, max(b.date) AS prev_date,
  arg_max(b.path, b.date) AS prev_path FROM files a LEFT JOIN files b ON a.tld = b.tld AND b.date >= a.date - 6 AND b.date < a.date
  GROUP BY a.tld, a.date, a.path""")
def _(spark, sf):
    return zone.previous_zone_file(zone.zone_files(_file_listing(spark, sf))[0])


def _ledger(spark, sf):
    """Imports done so far, two per nation; none for the nations of one region."""
    n = table(spark, sf, "nation")
    return n.where(F.col("n_regionkey") != 2).select(
        F.concat(F.lit("n"), F.col("n_nationkey")).alias("tld"),
        F.explode(F.array(F.lit("1999-01-01").cast("date"), F.date_add(F.lit("1999-06-01").cast("date"), F.col("n_nationkey"))))
        .alias("date"))


@query("pending_imports", f"""WITH {_FILES_SQL}, led AS (SELECT 'n' || n_nationkey AS tld, DATE '1999-06-01' + n_nationkey AS date
  FROM nation WHERE n_regionkey <> 2)
  SELECT f.tld, f.date, f.path FROM files f LEFT JOIN led ON led.tld = f.tld
  WHERE f.date > coalesce(led.date, DATE '2000-02-17') AND f.tld <> 'n4'""")
def _(spark, sf):
    files = zone.zone_files(_file_listing(spark, sf))[0]
    return zone.pending_imports(files, _ledger(spark, sf), exclude=["n4"], default="2000-02-17")


@query("last_imported", "SELECT 'n' || n_nationkey AS tld, DATE '1999-06-01' + n_nationkey AS date FROM nation WHERE n_regionkey <> 2")
def _(spark, sf):
    return zone.last_imported(_ledger(spark, sf))


@query("zone_updates", f"""WITH {ZONE_SQL}, nd AS (SELECT domain, [regexp_extract(x, '[^.]+[.][^.]+$') for x in ns] AS d, ns FROM chg),
  full_ AS (SELECT domain, ns FROM prv)
  SELECT DATE '2024-03-03' AS zonefile_date, domain, array_to_string(ns, ',') AS ns,
    array_to_string(list_sort(list_distinct(d)), ',') AS ns_domains, 'com' AS tld, 'zonefile' AS modified_by FROM nd
  UNION ALL SELECT DATE '2024-03-01', domain, array_to_string(ns, ','),
    array_to_string(list_sort(list_distinct([regexp_extract(x, '[^.]+[.][^.]+$') for x in ns])), ','), 'com', 'zonefile' FROM full_""")
def _(spark, sf):
    records = zone_records(spark, sf)
    days = records.select("tld", "date").distinct()
    plan = days.withColumn("prev_date", F.when(F.col("date") == F.lit("2024-03-03").cast("date"), F.lit("2024-03-01").cast("date")))
    up = jobs.zone_updates(jobs.zone_changes(records, plan), shaped.suffixes(spark))
    return up.select("zonefile_date", "domain", F.array_join("ns", ",").alias("ns"),
                     F.array_join("ns_domains", ",").alias("ns_domains"), "tld", "modified_by")


@query("follow_up_requests", f"""WITH {UPDATES_SQL}, z AS (SELECT domain FROM upd WHERE modified_by = 'zonefile')
  SELECT 'scrape.dns' AS topic, domain AS key, '{{}}' AS value FROM z UNION ALL SELECT 'scrape.rdap', domain, '{{}}' FROM z""")
def _(spark, sf):
    from zonewright.operators.selection import follow_ups
    return follow_ups(event_updates(spark, sf), shaped.suffixes(spark))


# --- streams: run to the end over the files, then read what they wrote --------------------------------
def _run_dir(spark) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _staged(frame, spark, where: str, topic: str):
    """Messages as files, which the stream then reads."""
    frame.select(F.lit(topic).alias("topic"), "key", "value", F.col("seq").alias("offset"),
                 F.col("arrived").alias("timestamp")).write.parquet(where)
    return messages.read_stream(spark, "parquet", {"maxFilesPerTrigger": "4"}, where)


@query("stream_updates", f"""WITH {_NX_MESSAGES}, j AS (SELECT *, 'u' || user_id || '.com' AS domain, {_REASON} AS reason FROM msgs),
  g AS (SELECT * FROM j WHERE reason IS NULL)
  SELECT domain, count(*) AS versions, coalesce(max(visits_12m), -1) AS visits_12m, bool_or(event_type = 'signup') AS nx_seen
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN k END AS visits_12m FROM g) GROUP BY domain""")
def _(spark, sf):
    from zonewright.streaming.store import VersionStore
    from zonewright.streaming.streams import stream_updates
    root = _run_dir(spark)
    source = _staged(event_messages(spark, sf), spark, f"{root}/in", "results")
    store = VersionStore(spark, f"{root}/store")
    stream_updates(source, store, f"{root}/checkpoint", shaped.suffixes(spark), compact_every=3,
                   trigger={"availableNow": True}).awaitTermination()
    best = F.max("visits_12m")
    return (store.log().groupBy("domain").agg(F.count(F.lit(1)).alias("versions"), F.coalesce(best, F.lit(-1)).alias("visits_12m"),
                                              F.bool_or(F.col("registered").eqNullSafe(F.lit(False))).alias("nx_seen")))


@query("stream_errors", """SELECT CAST(ts AS DATE) AS day, event_type AS error_type, count(*) AS count, count(*) AS uuids FROM events GROUP BY ALL""")
def _(spark, sf):
    from zonewright.streaming.streams import stream_errors
    root = _run_dir(spark)
    e = event_errors(spark, sf)
    body = F.to_json(F.struct("error", F.replace("error", F.lit("failed with "), F.lit("")).alias("error_type"), "file",
                              "line", "traceback", "scraper", "topic",
                              F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    sent = e.select(F.col("domain").alias("key"), body.alias("value"), F.lit(0).cast("bigint").alias("seq"),
                    F.col("timestamp").cast("timestamp").alias("arrived"))
    source = _staged(sent, spark, f"{root}/in", "errors")
    for running in stream_errors(source, f"{root}/errors", f"{root}/checkpoint", f"{root}/unread", {"availableNow": True}):
        running.awaitTermination()
    out = spark.read.schema(schema.ERROR_SCHEMA + ", day date").parquet(f"{root}/errors")
    return out.groupBy("day", "error_type").agg(F.count(F.lit(1)).alias("count"), F.countDistinct("uuid").alias("uuids"))


@query("stream_request_rate", """WITH c AS (SELECT event_type AS target, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS slot, count(*) AS n
  FROM events GROUP BY ALL), last_ AS (SELECT max(slot) AS m FROM c)
  SELECT a.target, to_timestamp(a.slot * 3600) AT TIME ZONE 'UTC' AS window_start, a.n AS cur_count, coalesce(b.n, 0) AS prev_count
  FROM c a LEFT JOIN c b ON a.target = b.target AND a.slot = b.slot + 1""")
def _(spark, sf):
    from zonewright.streaming.streams import stream_request_rate
    root = _run_dir(spark)
    events = (spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")  # a file or a folder of files: a stream takes a pattern for either
              .withColumn("ts", F.col("ts").cast("timestamp")))
    rate = stream_request_rate(events, "event_type", "ts", 4, unit="1 hour", unit_seconds=3600, late="1 hour")
    # an update-mode run gives each window's newest state per batch, the last one being final
    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/rate/batch_id={batch_id}")
    (rate.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(f"{root}/rate")
    newest = out.groupBy("target", "window_start").agg(F.max_by(F.struct("cur_count", "prev_count"), "batch_id").alias("r"))
    return newest.select("target", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "r.cur_count", "r.prev_count")
