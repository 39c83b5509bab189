"""Session helpers.

The library never creates a session behind the caller's back; these helpers are for tests,
the bench and scripts.  ``work_dir`` returns the shared folder used for lineage cuts and
file round trips: the cluster's ``spark.checkpoint.dir``; in local mode without one, a folder in
the session's warehouse.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed value: the JVM interprets methods with more bytecode than this instead of compiling them.
JIT_METHOD_BYTES = 8000


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "abtforge") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ABT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture for error messages costs a stack walk and several JVM
        # round trips per builder call; off for batch runs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # checkpoint files of slice tags are removed once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; one in the warehouse is set only in local mode, when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        # which folder the executors share is the cluster's to say: refuse rather than guess
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster")
    target = configured or (spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse").rstrip("/") + "/_work"
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location, unique per application and call."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/abtforge/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For jobs over many columns: Spark generates no method that the JVM would not compile.

    One generated method per stage coerces and clips all columns of a wide table; beyond ``JIT_METHOD_BYTES`` it
    is interpreted.  With the limit set, such stages use Spark's per-operator code, which is split.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(JIT_METHOD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)
