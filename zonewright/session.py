"""Session settings the jobs rely on, and the shared folder for state."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the sizing: initial partitions are coalesced, skewed join partitions are
# split, and a join side is broadcast only after its real size was seen to be under the threshold.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints go once no frame refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; on a cluster pass CONF to spark-submit instead."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("zonewright")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false"))
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: what the cluster names in spark.checkpoint.dir.

    Only where that is unset in local mode (tests, one machine) a temporary folder is made and used.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="zonewright-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


# fixed value: bytes of byte code above which HotSpot never compiles a method, but interprets it for good
_JIT_LIMIT = 8000


@contextmanager
def compiled_wide(spark: SparkSession) -> Iterator[None]:
    """For jobs that run inside and whose steps handle the wide table: no generated method is too long to be compiled.

    Spark fuses the steps of a stage into one method, and by default accepts ones that the JVM then only interprets (the fold of
    the whole table is one). Stages with such a method run step by step instead, each in several short methods.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), _JIT_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df worked out once and kept in the shared folder: later jobs and lost executors start from there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
