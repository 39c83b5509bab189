"""Data-quality checks (V4-V7, A10) as aggregates: one pass per table."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.operators.joins import duplicate_key_groups


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, n_rows)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_key_counts(tables: Mapping[str, DataFrame], key_columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, n_rows, n_nulls) for every key column a table has.

    Each table is scanned once: all its NULL counts are conditional counts of one aggregate,
    then unpivoted.  Absent columns are skipped.
    """
    parts = []
    for name, df in tables.items():
        present = [k for k in key_columns if k in df.columns]
        if not present:
            continue
        wide = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(k).isNull()).alias(f"nulls__{k}") for k in present],
        )
        long = wide.unpivot(["n_rows"], [f"nulls__{k}" for k in present], "column_name", "n_nulls")
        parts.append(long.select(
            F.lit(name).alias("table_name"),
            F.regexp_replace("column_name", "^nulls__", "").alias("column_name"),
            "n_rows",
            "n_nulls",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups seen more than once, with their count ``n``."""
    return duplicate_key_groups(df, keys)


def duplicates_by_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """rows_total, distinct_keys, dup_rows for a key (one or more columns).

    Distinct keys are counted as groups of a ``groupBy`` (partial aggregation on the map
    side, so a hot key costs one row per task), not with a global ``count(distinct)``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # COUNT(DISTINCT k) ignores NULL keys; so do we.
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_nn", nonnull)
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("rows_total"),
        F.count_if(F.col("_nn")).alias("distinct_keys"),
    ).select(
        F.coalesce("rows_total", F.lit(0).cast("bigint")).alias("rows_total"),
        "distinct_keys",
        (F.coalesce("rows_total", F.lit(0).cast("bigint")) - F.col("distinct_keys")).alias("dup_rows"),
    )


def sanity_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum of each listed column that exists (to see that a join did not leave only zeros)."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, total double")
    wide = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in present])
    return wide.unpivot([], present, "column_name", "total")
