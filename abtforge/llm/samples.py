"""Bounded, deterministic training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.store import written


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, limit: int) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows outside the held-out fold that ``docs`` has.

    The sample is the ``limit`` smallest id hashes: independent of partitioning, and bounded before
    any text is read.  Several labels of one id vote (ties count as 1).
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out)
         .groupBy("doc_id").agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("y")))
    there = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(y, "doc_id")
    return written(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "sample")
