"""Ranks within groups of any size, without a task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtforge.llm.store import written

BROADCAST_STRETCHES = 100_000


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Adds ``lo`` (rank in the tree from 0, by ``order``), ``hi`` = lo + 1 and ``n`` (rows of the tree).

    Rows are dealt by range, sorted, numbered as they lie and written; a row's rank is its distance
    from the first row of its tree in its partition plus what the tree has in partitions before.
    """
    keys = [tree, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt, f"{name}-ordered").withColumn("_part", F.shiftright("_at", 33))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = dealt.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    stretches = written(stretches.select(tree, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                                         F.sum("_n").over(whole).alias("n")), f"{name}-stretches")
    if stretches.count() <= BROADCAST_STRETCHES:
        stretches = F.broadcast(stretches)
    lo = F.col("_at") + F.col("_shift")
    return dealt.join(stretches, [tree, "_part"]).withColumn("lo", lo).withColumn("hi", lo + 1).drop("_at", "_part", "_shift")
