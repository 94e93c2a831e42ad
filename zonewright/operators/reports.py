"""Reports over the current view and the error log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRANSIENT_ERRORS = ["SSLError", "ProxyError", "ReadTimeout", "HTTPError"]
SAMPLE = 10


def moment(df: DataFrame, col: str, as_of) -> Column:
    """`as_of` as a literal of the column's own timestamp type."""
    return F.lit(str(as_of)).cast(df.schema[col].dataType)


def ago(df: DataFrame, col: str, as_of, **interval) -> Column:
    return moment(df, col, as_of) - F.make_dt_interval(
        F.lit(interval.get("days", 0)), F.lit(interval.get("hours", 0)))


def scrape_age_report(current: DataFrame, as_of, cols: Sequence[str] = ("dns_scraped", "whois_scraped")) -> DataFrame:
    """One row of counts per age band. Bands include both ends, so an exact boundary counts twice."""
    counts = []
    for c in cols:
        t = F.col(c)

        def before(days: int) -> Column:
            return ago(current, c, as_of, days=days)

        bands = {"never": t.isNull(), "gt_90": t < before(90), "60_90": t.between(before(90), before(60)),
                 "30_60": t.between(before(60), before(30)), "30_7": t.between(before(30), before(7)),
                 "lt_7": t > before(7)}
        counts += [F.count_if(cond).alias(f"{c}_{band}") for band, cond in bands.items()]
    return current.agg(*counts)


def scraped_last_day(current: DataFrame, as_of, col: str = "dns_scraped") -> DataFrame:
    return current.agg(F.count_if(F.col(col) > ago(current, col, as_of, days=1)).alias("count"))


def ns_domain_report(current: DataFrame) -> DataFrame:
    """Available names that serve as nameserver domain for more than one name: `(ns, count)`.

    One pass and no join: a row gives one count to each of its nameserver domains and, if it is
    available itself, a mark to its own name. Counts and marks of a name meet in one aggregate that
    is combined before the shuffle.
    """
    def line(name: Column, n: int, free: bool) -> Column:
        return F.struct(name.alias("ns"), F.lit(n).cast("bigint").alias("n"), F.lit(free).alias("free"))

    none = F.array().cast("array<struct<ns:string,n:bigint,free:boolean>>")
    uses = F.coalesce(F.transform("ns_domains", lambda x: line(x, 1, False)), none)
    own = F.when(~F.col("registered"), F.array(line(F.col("domain"), 0, True))).otherwise(none)
    lines = current.select(F.inline(F.concat(uses, own))).where(F.col("ns").isNotNull())
    totals = lines.groupBy("ns").agg(F.sum("n").alias("count"), F.bool_or("free").alias("_free"))
    return totals.where(F.col("_free") & (F.col("count") > 1)).drop("_free").orderBy(F.desc("count"), "ns")


# --- error log -------------------------------------------------------------------------------
_GROUP = ["error_type", "file", "line", "scraper", "topic"]


def recent_errors(errors: DataFrame, as_of=None, days: int | None = 3, sample: int = SAMPLE) -> DataFrame:
    """Errors of the last days (None: all) by kind: up to ten ids with their names (earliest first), count, latest.

    The ten are picked by a ranked window, which keeps ten per kind in every task before the
    shuffle; a kind that makes up most of the log is never gathered. Count and latest are carried
    to it from a plain aggregate.
    """
    recent = errors if days is None else errors.where(F.col("timestamp") > ago(errors, "timestamp", as_of, days=days))
    totals = recent.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("count"), F.max("timestamp").alias("latest"))
    rank = Window.partitionBy(*_GROUP).orderBy("timestamp", "uuid")
    picked = (recent.select(*_GROUP, "timestamp", "uuid", "domain", F.row_number().over(rank).alias("_rn"))
              .where(F.col("_rn") <= sample).groupBy(*_GROUP)
              .agg(F.array_sort(F.collect_list(F.struct("_rn", "uuid", "domain"))).alias("_s")))
    same = [totals[c].eqNullSafe(picked[c]) for c in _GROUP]
    joined = totals.join(picked, same, "inner")
    return joined.select(F.col("_s.uuid").alias("uuids"), *[totals[c] for c in _GROUP],
                         F.col("_s.domain").alias("domains"), "count", "latest").orderBy(F.desc("count"), *_GROUP)


def latest_errors(errors: DataFrame, n: int = 100) -> DataFrame:
    cols = ["uuid", "error_type", "error", "file", "line", "scraper", "domain", "timestamp"]
    return errors.select(*cols).orderBy(F.desc_nulls_last("timestamp"), "uuid").limit(n)


def error_details(errors: DataFrame, uuid: str) -> DataFrame:
    cols = ["domain", "error", "error_type", "file", "line", "scraper", "topic", "timestamp", "traceback", "uuid"]
    return errors.where(F.col("uuid") == uuid).select(*cols)


def failed_scrapes(errors: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Distinct (domain, scraper) of transient failures in the last day."""
    since = F.col("timestamp") >= ago(errors, "timestamp", as_of, days=days)
    return errors.where(since & F.col("error_type").isin(*TRANSIENT_ERRORS)).select("domain", "scraper").distinct()


# --- request rates -----------------------------------------------------------------------------
def rate_parts(requests: DataFrame, target: str, ts: str, unit_seconds: int) -> DataFrame:
    """Each request twice: as one of its own window and as one of the window before the next."""
    slot = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (unit_seconds * 1_000_000))
    twice = F.explode(F.array(F.struct(slot.alias("slot"), F.lit(1).alias("cur"), F.lit(0).alias("prev")),
                              F.struct((slot + 1).alias("slot"), F.lit(0).alias("cur"), F.lit(1).alias("prev"))))
    return requests.select(F.col(target).alias("target"), twice.alias("_p")).select("target", "_p.*")


def request_rate(requests: DataFrame, target: str, ts: str, capacity: float, unit_seconds: int = 1,
                 at: float = 0.0) -> DataFrame:
    """Sliding-window load per target and window: previous count x remaining share + current count.

    `at` is the point in the window (0 start, 1 end) the share is taken at. A request adds to its
    own window and to the next one's "previous", so one partial aggregate does it, with no window
    function over all windows of a target.
    """
    counts = (rate_parts(requests, target, ts, unit_seconds).groupBy("target", "slot")
              .agg(F.sum("cur").alias("cur_count"), F.sum("prev").alias("prev_count")).where(F.col("cur_count") > 0))
    load = F.col("prev_count") * F.lit(1.0 - at) + F.col("cur_count")
    start = F.timestamp_seconds(F.col("slot") * unit_seconds)
    return counts.select("target", start.alias("window_start"), "cur_count", "prev_count",
                         load.alias("load"), (load > capacity).alias("over_limit"))
