"""Append-only version log with compacted snapshots, for streams that upsert.

Layout under one shared folder:
  log/span=S/batch_id=N/date=D/  versions written by batch N (written whole; a repeated batch replaces it), by day;
                           S = N / 1000, so readers of the newest batches list the newest spans only
  base/upto=N/bucket=B/    latest row per domain as of batch N, split in hash buckets, sorted by name in each
  base_done/               which bases are complete, and their number of buckets
  base_dropped/            which bases were given up; noted before their folders go
  runs/                    number of each streaming query's first batch in this store
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.operators.latest import latest_by_key

ORDER = ("last_modified", "batch_id", "seq")
SPAN = 1000  # batches in one folder of the log


class VersionStore:
    """`order` decides which version is the current one. By default the greatest change time, so an
    update dated before the stored row (a zone file carries midnight) enters the history only; use
    ("batch_id", "seq") to let arrival decide.

    `buckets` is the least number of buckets of a base; more are taken where a bucket would hold more than
    `bucket_rows` rows."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, order: Sequence[str] = ORDER,
                 bucket_rows: int = 1_000_000):
        self.spark, self.root, self.buckets, self.order = spark, root.rstrip("/"), buckets, tuple(order)
        self.bucket_rows, self._first = bucket_rows, {}

    # --- writing ---------------------------------------------------------------------------------
    def append(self, versions: DataFrame, batch_id: int) -> None:
        out = versions.select("seq", *schema.TABLE_COLS, F.to_date("last_modified").alias("date"))
        out.write.partitionBy("date").mode("overwrite").parquet(f"{self.root}/{self._log_dir(batch_id)}")

    @staticmethod
    def _log_dir(batch_id: int) -> str:
        return f"log/span={batch_id // SPAN}/batch_id={batch_id}"

    def first_batch(self, run: str) -> int:
        """Number in this store of batch 0 of a streaming query, by the id that its checkpoint keeps.

        A query with a new checkpoint counts from 0 again; here its batches go on after all that is stored, so
        it replaces nothing. One query at a time may write to a store. The number is looked up once per query.
        """
        if run not in self._first:
            self._first[run] = self._find_first(run)
        return self._first[run]

    def _find_first(self, run: str) -> int:
        runs = self._read("runs", "run string, first bigint")
        known = None if runs is None else runs.where(F.col("run") == run).agg(F.min("first")).first()[0]
        if known is not None:
            return known
        spans = self._numbers("log", "span")
        last = max(self._numbers(f"log/span={max(spans)}", "batch_id"), default=-1) if spans else -1
        earlier = None if runs is None else runs.agg(F.max("first")).first()[0]
        first = max(last, self._base(None)[1], -1 if earlier is None else earlier) + 1
        self.spark.range(1).select(F.lit(run).alias("run"), F.lit(first).cast("bigint").alias("first")).write.mode("append").parquet(f"{self.root}/runs")
        return first

    def side_output(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def compact(self, upto: int) -> None:
        """Write the latest view as of a batch to its own folder, then note it as complete.

        Nothing that may be read meanwhile is changed; a repeated call replaces its own folder.
        """
        view = self.current(before=upto + 1, base_before=upto, with_order=True)
        buckets = self._bucket_count(upto)
        bucketed = view.withColumn("bucket", self._bucket(buckets))
        (bucketed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "domain").write.partitionBy("bucket")
         .mode("overwrite").parquet(f"{self.root}/base/upto={upto}"))
        done = self.spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"), F.lit(buckets).alias("buckets"))
        done.write.mode("append").parquet(f"{self.root}/base_done")

    def _bucket_count(self, upto: int) -> int:
        """Buckets for a base: `buckets`, or as many as the rows it is made from need; for a base made again as
        many as it had. Rows of the older base and of the log are counted, a name in both twice."""
        done = self._done()
        known = None if done is None else done.where(F.col("upto") == upto).agg(F.max("buckets")).first()[0]
        if known is not None:
            return known
        base, covered, _ = self._base(upto)
        rows = self._tail(covered, upto + 1).count() + (0 if base is None else base.count())
        return max(self.buckets, -(-rows // self.bucket_rows))

    def drop_old_bases(self, keep: int = 2) -> list[int]:
        """Give up all but the newest `keep` complete bases, remove their folders and return their numbers.

        The log stays whole, so views as of older batches are made from an older base that is left or from the log.
        A batch that is repeated reads the base before its own, hence two. What a call that was cut short has left
        over, the next one removes.
        """
        if keep < 1:
            raise ValueError("at least one base stays")
        done = self._done()
        if done is None:
            return []
        # one row per compaction whose base was not given up
        old = sorted({n for (n,) in done.select("upto").distinct().collect()})[:-keep]
        if old:
            self.spark.createDataFrame([(n,) for n in old], "upto bigint").coalesce(1).write.mode("append").parquet(f"{self.root}/base_dropped")
        dropped = self._read("base_dropped", "upto bigint")
        gone = set() if dropped is None else {n for (n,) in dropped.distinct().collect()}
        for n in sorted(gone & set(self._numbers("base", "upto"))):
            path = self._path(f"base/upto={n}")
            path.getFileSystem(self._hadoop()).delete(path, True)
        return old

    @staticmethod
    def _bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64("domain"), F.lit(buckets)).cast("int")

    # --- reading ---------------------------------------------------------------------------------
    def _hadoop(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _numbers(self, name: str, key: str) -> list[int]:
        """Numbers of the folders `key=number` right below a folder; only their names are listed."""
        path = self._path(name)
        fs = path.getFileSystem(self._hadoop())
        if not fs.exists(path):
            return []
        found = (f.getPath().getName() for f in fs.listStatus(path))
        return [int(f.removeprefix(f"{key}=")) for f in found if f.startswith(f"{key}=")]

    def _read(self, name: str, ddl: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # nothing written yet

    @staticmethod
    def _ddl(*extra: str) -> str:
        return ", ".join(["seq bigint", *[f"{c} {t}" for c, t in schema.TABLE_TYPES.items()], *extra])

    def history(self) -> DataFrame:
        """Every version with its batch and day; a filter on `date` or `batch_id` reads only those folders."""
        ddl = self._ddl("batch_id bigint", "date date")
        found = self._read("log", ddl)
        return found.drop("span") if found is not None else self.spark.createDataFrame([], ddl)

    def _tail(self, after: int, before: int | None) -> DataFrame:
        """The log of the batches after one and before another: only folders of their spans are listed, and only
        theirs are read, however long the log has grown."""
        folders = []
        for span in self._numbers("log", "span"):
            if (span + 1) * SPAN > after + 1 and (before is None or span * SPAN < before):
                folders += [self._log_dir(n) for n in self._numbers(f"log/span={span}", "batch_id") if n > after and (before is None or n < before)]
        ddl = self._ddl("batch_id bigint", "date date")
        if not folders:
            return self.spark.createDataFrame([], ddl).drop("date")
        reader = self.spark.read.schema(ddl).option("basePath", f"{self.root}/log")
        return reader.parquet(*[f"{self.root}/{f}" for f in sorted(folders)]).drop("date", "span")

    def log(self) -> DataFrame:
        return self.history().drop("date")

    def _done(self) -> DataFrame | None:
        """Complete bases that were not given up: (upto, buckets)."""
        done, dropped = self._read("base_done", "upto bigint, buckets int"), self._read("base_dropped", "upto bigint")
        return done if done is None or dropped is None else done.join(dropped, "upto", "left_anti")

    def _base(self, before: int | None) -> tuple[DataFrame | None, int, int | None]:
        """Newest complete base (older than a batch), the last batch it covers, and its number of buckets."""
        done = self._done()
        if done is None:
            return None, -1, None
        found = done.where(F.lit(True) if before is None else F.col("upto") < before)
        newest = found.agg(F.max(F.struct("upto", "buckets")).alias("b")).select("b.*").first()
        if newest["upto"] is None:
            return None, -1, None
        return self._read(f"base/upto={newest['upto']}", self._ddl("batch_id bigint", "bucket int")), newest["upto"], newest["buckets"]

    def current(self, before: int | None = None, touched: DataFrame | None = None, with_order: bool = False,
                base_before: int | None = None) -> DataFrame:
        """Latest row per domain, from the newest base and the batches after it.

        `before` leaves out that batch and later ones, so a repeated batch does not see its own
        output. `touched(domain)` cuts both parts down to those names before any shuffle of them, and of the base
        only the buckets of those names are read.
        """
        base, upto, buckets = self._base(before if base_before is None else base_before)
        tail = self._tail(upto, before)
        if base is not None and touched is not None and buckets:
            # at most as many numbers as there are buckets
            numbers = [n for (n,) in touched.where("domain is not null").select(self._bucket(buckets)).distinct().collect()]
            base = base.where(F.col("bucket").isin(numbers))
        log = tail if base is None else tail.unionByName(base.drop("bucket"))
        if touched is not None:
            log = log.join(touched.select("domain").distinct(), "domain", "left_semi")
        view = latest_by_key(log, "domain", self.order)
        return view if with_order else view.drop("seq", "batch_id")
