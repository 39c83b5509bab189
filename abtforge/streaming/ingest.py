"""New files of a landing folder -> Parquet table, exactly once per file.

A file-source stream with an explicit schema, run with ``trigger(availableNow=True)``: it
processes every file that arrived since the last run (in bounded micro-batches, so a large
backlog never lands in one batch) and stops.  The checkpoint records which files were
committed; the Parquet sink's commit log makes re-runs after a failure idempotent.  The
checkpoint belongs under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_new_files(spark: SparkSession, source_dir: str, schema: T.StructType | str, target_path: str,
                     checkpoint_path: str, fmt: str = "csv", max_files_per_trigger: int = 1000,
                     partition_by: Sequence[str] = (), add_ingest_time: bool = False,
                     options: dict | None = None) -> None:
    """Append rows of files new since the last run to ``target_path``."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)
    if add_ingest_time:
        stream = stream.withColumn("_ingested_at", F.current_timestamp())
    writer = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_path)
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.start(target_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
