"""Written intermediate tables in the folder that the whole cluster shares.

``written`` cuts lineage: a frame is written as Parquet under ``spark.checkpoint.dir`` and read
back with its schema, so a lost executor costs a reread and never a recomputation.  ``spent`` removes such
a table once everything that needs it is written itself.
"""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, a local session uses a folder in
    its warehouse, and any other refuses: its executors would not see each other's files."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def spent(*frames: DataFrame) -> None:
    """Delete tables that ``written`` returned; nothing may read them any more."""
    for df in frames:
        path = _paths.pop(df, None)
        if path:
            context = df.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
