"""Profiles of appended data: a small state per part, added up without reading old parts again.

The state of a part (a month, a load, a file) has one row per column and bucket of its values:
how many there are, their mean and centred second moment, smallest and largest.  Buckets are a fixed
logarithmic grid - values of one bucket differ by at most ``2 * ACCURACY`` of their size - with zero, and the
unknown values (NULL, NaN, infinite, text that is no number), in buckets of their own.  So states add up to
what one state of everything would be, bucket by bucket and whatever the order: counts, extremes and
buckets exactly, moments up to rounding, and quantiles within ``ACCURACY`` of the value.

Size: at most about 71,000 buckets a column and sign (the whole range of doubles), a few hundred as a rule.
A part is replaced as a whole, so profiling it again changes nothing.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ACCURACY = 0.01
_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
_OFFSET = 1_000_000  # keeps the codes of values below 1 apart from their sign

_STATE = "column_name string, bucket int, n long, mean double, m2 double, least double, most double"


def bucket_of(value: Column) -> Column:
    """Code of a value's bucket, in the order of values: 0 for zero, NULL for unknown."""
    place = (F.ceil(F.log(F.abs(value)) / F.lit(math.log(_GAMMA))) + _OFFSET).cast("int")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, F.when(value == 0, 0).when(value > 0, place).otherwise(-place))


def bucket_value(bucket: Column) -> Column:
    """The value that stands for a bucket: none of its values is further away than ``ACCURACY`` of itself."""
    size = F.pow(F.lit(_GAMMA), (F.abs(bucket) - _OFFSET).cast("double")) * (2 / (_GAMMA + 1))
    return F.when(bucket == 0, 0.0).when(bucket > 0, size).otherwise(-size)


def profile_state(df: DataFrame, cols: Sequence[str], part: str) -> DataFrame:
    """State rows of every part of ``df``: (part, column_name, bucket, n, mean, m2, least, most), one scan."""
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").try_cast("double").alias("value")) for c in cols])
    long = df.select(F.col(part).cast("string").alias("part"), F.explode(values).alias("x")).select("part", "x.column_name", "x.value")
    known = F.when(F.col("bucket").isNotNull(), F.col("value"))
    return long.withColumn("bucket", bucket_of(F.col("value"))).groupBy("part", "column_name", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.avg(known).alias("mean"), (F.var_pop(known) * F.count(known)).alias("m2"), F.min(known).alias("least"), F.max(known).alias("most"))


def append_parts(df: DataFrame, cols: Sequence[str], part: str, path: str) -> None:
    """Profile the parts that ``df`` holds and put their states into the folder ``path``.

    Other parts are neither read nor rewritten.  A part must come whole: it replaces its earlier state.
    """
    state = profile_state(df, cols, part).repartition("part")
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def stored_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_STATE}, part string").parquet(path)


def combined(state: DataFrame) -> DataFrame:
    """The buckets of all parts added up: (column_name, bucket, n, mean, m2, least, most)."""
    sums = state.groupBy("column_name", "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                                      F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))).alias("mean"))
    centre = sums.select(F.col("column_name").alias("_c"), F.col("bucket").alias("_b"), F.col("mean").alias("_mean"))
    away = F.col("mean") - F.col("_mean")
    spread = (state.join(centre, (F.col("column_name") == F.col("_c")) & F.col("bucket").eqNullSafe(F.col("_b")))
              .groupBy("_c", "_b").agg(F.sum(F.col("m2") + F.col("n") * away * away).alias("m2")))
    both = sums.join(spread, (F.col("column_name") == F.col("_c")) & F.col("bucket").eqNullSafe(F.col("_b")))
    return both.select("column_name", "bucket", "n", "mean", "m2", "least", "most")


def summary(state: DataFrame, qs: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(column_name, n_rows, n_unknown, n_zero, min, max, avg, std, p<q>...): one row per column, from states alone.

    A quantile is that of the value at rank floor(q * (n - 1)).
    """
    found = combined(state).checkpoint(eager=True) if state.sparkSession.sparkContext.getCheckpointDir() else combined(state)
    known = F.col("bucket").isNotNull()
    per = found.groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown"),
                                           F.coalesce(F.sum(F.when(F.col("bucket") == 0, F.col("n"))), F.lit(0)).alias("n_zero"), F.min("least").alias("min"),
                                           F.max("most").alias("max"), F.try_divide(F.sum(F.when(known, F.col("n") * F.col("mean"))), F.sum(F.when(known, F.col("n")))).alias("avg"))
    away = F.col("mean") - F.col("avg")
    placed = found.join(per, "column_name")
    total = F.col("n_rows") - F.col("n_unknown")
    spread = placed.where(known).groupBy("column_name").agg(F.sum(F.col("m2") + F.col("n") * away * away).alias("_m2"))
    up_to = Window.partitionBy("column_name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.where(known).withColumn("_end", F.sum("n").over(up_to))
    holds = lambda q: (F.floor(F.lit(q) * (total - 1)) < F.col("_end")) & (F.floor(F.lit(q) * (total - 1)) >= F.col("_end") - F.col("n"))
    value = F.greatest(F.least(bucket_value(F.col("bucket")), F.col("most")), F.col("least"))
    quantiles = ranked.groupBy("column_name").agg(*[F.max(F.when(holds(q), value)).alias(f"p{round(q * 100):g}") for q in qs])
    std = F.sqrt(F.try_divide(F.col("_m2"), F.when(total > 1, (total - 1).cast("double"))))
    return per.join(spread, "column_name", "left").join(quantiles, "column_name", "left").select(
        "column_name", "n_rows", "n_unknown", "n_zero", "min", "max", "avg", std.alias("std"), *[f"p{round(q * 100):g}" for q in qs])
