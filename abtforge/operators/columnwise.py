"""Per-column statistics of any number of columns, in one scan.

Each row is turned into (position, value) pairs and aggregated by position.  Partial aggregation
leaves at most columns x tasks rows to shuffle, buffers hold the statistics of one column only, and
the plan is the same for ten columns and for ten thousand: one scan, one generator, one aggregate.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stat = Callable[[Column], Column]


def as_double(c: Column) -> Column:
    return c.try_cast("double")  # text that is no number counts as NULL


def column_stats(df: DataFrame, cols: Sequence[str], stats: Mapping[str, Stat], value: Stat = as_double,
                 extra: Sequence[str] = (), empty: Mapping[str, object] | None = None) -> DataFrame:
    """(column_name, <stat>...) with one row per column.

    ``value`` brings every column to one common type; ``stats`` maps an output name to an
    aggregate of that value; ``extra`` names further columns the aggregates read (a target, for
    example).  A table without rows still gives one row per column, with ``empty``'s values.
    """
    cols = list(cols)
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(cols)), "_position int, column_name string")
    pairs = df.select(*[F.col(f"`{c}`") for c in extra],
                      F.posexplode(F.array(*[value(F.col(f"`{c}`")) for c in cols])).alias("_position", "_value"))
    found = pairs.groupBy("_position").agg(*[fn(F.col("_value")).alias(n) for n, fn in stats.items()])
    out = names.join(found, "_position", "left").select("column_name", *stats)
    return out.fillna(dict(empty)) if empty else out
