"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="zonewright-llm-")


def small_batches(spark: SparkSession) -> None:
    """At most 1,000 rows in an Arrow batch, so that whole texts in flight take a few MB, unless the session asks for fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= 1000:
        spark.conf.set(name, "1000")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below spark.checkpoint.dir; a temporary one only where that is unset in local mode."""
    small_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """df as a table written once and read back: later jobs and retries start from it."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove tables of kept() that nothing reads any more: what was made from them must have been written itself."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
