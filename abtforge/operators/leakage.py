"""Leakage checks (P31, A12, A13, M9): by name, perfect copies, near-perfect correlation.

All value checks run on every row in one scan (see ``columnwise``); only the verdict per column (a handful
of booleans or one correlation) reaches the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.functions.names import leak_by_name
from abtforge.functions.stats import safe_corr
from abtforge.operators.columnwise import column_stats

_CHECKS = ("binary", "equals_target", "equals_complement", "corr")


def target_correlation(df: DataFrame, cols: Sequence[str], target: str, thr: float = 0.999) -> DataFrame:
    """(column_name, corr, flagged): Pearson r with the target over pairwise-complete rows.

    Constant columns get NULL and are never flagged (Spark's ``corr`` raises on them under
    ANSI, and NaN >= thr would be true).
    """
    out = _checks(df, cols, target, ("corr",))
    return out.select("column_name", "corr",
                      F.coalesce(F.abs(F.col("corr")) >= F.lit(thr), F.lit(False)).alias("flagged"))


def perfect_leakage(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column_name, binary, equals_target, equals_complement) over all rows.

    A column counts as binary when every non-NULL value is 0 or 1 (and it has at least one).
    Equality is NULL-safe: a NULL in the column matches only a NULL target.
    """
    return _checks(df, cols, target, ("binary", "equals_target", "equals_complement"))


def _checks(df: DataFrame, cols: Sequence[str], target: str, wanted: Sequence[str] = _CHECKS) -> DataFrame:
    """The wanted checks of every column against the target, from one scan."""
    y = F.col(f"`{target}`").cast("double")
    always = lambda cond: F.coalesce(F.bool_and(cond), F.lit(False))
    every = {
        "binary": lambda x: always(x.isNull() | x.isin(0.0, 1.0)) & (F.count(x) > 0),
        "equals_target": lambda x: always(x.eqNullSafe(y)),
        "equals_complement": lambda x: always((F.lit(1.0) - x).eqNullSafe(y)),
        "corr": lambda x: safe_corr(x, y),
    }
    flags = {name: False for name in wanted if name != "corr"}
    return column_stats(df, cols, {name: every[name] for name in wanted}, extra=[target], empty=flags or None)


def leakage_report(df: DataFrame, cols: Sequence[str], target: str, thr: float = 0.999) -> DataFrame:
    """(column_name, reason) for every column to drop: 'name', 'perfect' or 'corr'.

    Name checks are plan-time; the value checks (perfect copy or complement of the target,
    near-perfect correlation) share one aggregate, so the data is read once.
    """
    spark = df.sparkSession
    safe, by_name = leak_by_name(cols)
    out = spark.createDataFrame([(c, "name") for c in by_name], "column_name string, reason string")
    if safe:
        chk = _checks(df, safe, target)
        perfect = F.col("binary") & (F.col("equals_target") | F.col("equals_complement"))
        corr = F.coalesce(F.abs(F.col("corr")) >= F.lit(thr), F.lit(False))
        reasons = chk.select("column_name", F.explode(F.array(
            F.when(perfect, F.lit("perfect")), F.when(corr, F.lit("corr")))).alias("reason"))
        out = out.unionByName(reasons.filter(F.col("reason").isNotNull()))
    return out


def columns_to_drop(report: DataFrame) -> list[str]:
    """The union of flagged columns, sorted (a list of names: bounded by the column count)."""
    return sorted({r["column_name"] for r in report.select("column_name").distinct().collect()})
