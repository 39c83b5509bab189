"""Profiling (A7-A11): NULL profile, numeric summary, top values, table profile.

Per-column statistics are one scan of the table (see ``columnwise``), never one query per column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)

# Column names that usually identify a client or record.
CANDIDATE_KEY_NAMES = ("num_doc", "documento", "id_cliente", "customer_id", "cliente_id", "id", "nit", "cedula")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def detect_candidate_keys(df: DataFrame, names: Sequence[str] = CANDIDATE_KEY_NAMES) -> list[str]:
    wanted = set(names)
    return [c for c in df.columns if c.lower() in wanted]


def null_profile(df: DataFrame, top: int | None = 20) -> DataFrame:
    """(column_name, nulls, null_pct) ordered by nulls desc then name; ``null_pct`` to 4 places.

    NULL counts of all columns come from one scan.
    """
    from abtforge.operators.columnwise import column_stats

    stats = column_stats(df, df.columns, {"nulls": lambda x: F.count_if(x), "_rows": lambda x: F.count(F.lit(1))},
                         value=F.isnull, empty={"nulls": 0, "_rows": 0})
    out = stats.select("column_name", "nulls",
                       F.round(F.col("nulls") / F.greatest(F.col("_rows"), F.lit(1)), 4).alias("null_pct"))
    out = out.orderBy(F.desc("nulls"), F.asc("column_name"))
    return out.limit(top) if top else out


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None,
                    exact: bool = True, accuracy: int = 10000, slices: int | None = None) -> DataFrame:
    """Per numeric column: min, avg, max, p50, p95, p99 (one row per column).

    ``exact`` (default): two scans (``quantiles.quantile_summary``), the first of which also gives
    min, avg and max.  ``exact=False``: one scan with ``percentile_approx``, bounded memory per
    column.
    """
    from abtforge.operators import quantiles as Q

    cols = numeric_columns(df) if cols is None else list(cols)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column_name string, min double, avg double, max double, p50 double, p95 double, p99 double")
    qs, names = [0.5, 0.95, 0.99], ["p50", "p95", "p99"]
    basic = {"min": F.min("value"), "avg": F.avg("value"), "max": F.max("value")}
    if not exact:
        agg = Q.approximate_quantiles(df, cols, qs, accuracy, **basic)
        return agg.select("column_name", *basic, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    summary, found = Q.quantile_summary(df, cols, qs, slices=slices, **basic)
    return summary.join(Q.pivot_quantiles(found, ["column_name"], qs, names), "column_name", "left").select("column_name", *basic, *names)


def top_values(df: DataFrame, col: str, top: int = 10) -> DataFrame:
    """Most frequent values of ``col`` with their count; ties broken by value for repeatability."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(top))


def table_profile(df: DataFrame, table_name: str, key_names: Sequence[str] = CANDIDATE_KEY_NAMES) -> DataFrame:
    """Long-format profile (table_name, metric, column_name, value).

    Metrics: rows, columns, NULLs per column (one scan), and for every
    candidate key column its distinct count and duplicate rows (one grouped count per key).
    """
    from abtforge.operators.columnwise import column_stats
    from abtforge.operators.quality import duplicates_by_key

    cols = df.columns
    nulls = column_stats(df, cols, {"nulls": lambda x: F.count_if(x), "_rows": lambda x: F.count(F.lit(1))},
                         value=F.isnull, empty={"nulls": 0, "_rows": 0})
    first = F.lit(cols[0])
    parts = [
        nulls.filter(F.col("column_name") == first).select(
            F.lit("rows").alias("metric"), F.lit(None).cast("string").alias("column_name"),
            F.col("_rows").cast("bigint").alias("value")),
        nulls.filter(F.col("column_name") == first).select(
            F.lit("columns").alias("metric"), F.lit(None).cast("string").alias("column_name"),
            F.lit(len(cols)).cast("bigint").alias("value")),
        nulls.select(F.lit("nulls").alias("metric"), "column_name", F.col("nulls").cast("bigint").alias("value")),
    ]
    for k in detect_candidate_keys(df, key_names):
        d = duplicates_by_key(df, k)
        parts.append(d.select(F.lit("distinct_keys").alias("metric"), F.lit(k).alias("column_name"),
                              F.col("distinct_keys").cast("bigint").alias("value")))
        parts.append(d.select(F.lit("dup_rows").alias("metric"), F.lit(k).alias("column_name"),
                              F.col("dup_rows").cast("bigint").alias("value")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out.select(F.lit(table_name).alias("table_name"), "metric", "column_name", "value")


def profile_table(df: DataFrame, table_name: str, sample_n: int = 10,
                  key_names: Sequence[str] = CANDIDATE_KEY_NAMES) -> dict:
    """The table profile as DataFrames (A11): ``metrics`` (rows, columns, NULLs per column,
    distinct keys and duplicate rows per candidate key: one aggregate), ``schema``
    (column, type), ``numeric`` (``numeric_summary`` of the numeric columns) and a
    ``sample`` of ``sample_n`` rows."""
    spark = df.sparkSession
    return {
        "metrics": table_profile(df, table_name, key_names),
        "schema": spark.createDataFrame([(n, t) for n, t in df.dtypes], "column_name string, data_type string"),
        "numeric": numeric_summary(df, numeric_columns(df)),
        "sample": df.limit(sample_n),
    }
