"""Labels and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.functions.split import hash_split, temporal_split


def add_label(df: DataFrame, source: str = "var_rta", target: str = "target_final") -> DataFrame:
    """``target_final`` = source as INT, first column; the source column is dropped."""
    return df.select(F.col(source).try_cast("int").alias(target),
                     *[F.col(f"`{c}`") for c in df.columns if c not in (source, target)])


def with_hash_split(df: DataFrame, id_column: str, method: str = "md5", source: str = "var_rta",
                    target: str = "target_final") -> DataFrame:
    """Label plus deterministic hash split on ``id_column`` (stable under row order and
    repartitioning: it depends on the id's text only)."""
    if not id_column:
        raise ValueError("hash split needs id_column")
    labelled = add_label(df, source, target)
    return labelled.select(target, hash_split(F.col(id_column), method=method).alias("split_group"),
                           *[c for c in labelled.columns if c != target])


def with_temporal_split(df: DataFrame, train_before: str | dt.date, test_start: str | dt.date,
                        test_end: str | dt.date, date_col: str = "f_analisis", source: str = "var_rta",
                        target: str = "target_final") -> DataFrame:
    """Label plus date-range split; the date is exposed as ``f_analisis_date`` (DATE)."""
    labelled = add_label(df, source, target)
    d = F.col(date_col).try_cast("date")
    rest = [c for c in labelled.columns if c not in (target, date_col)]
    return labelled.select(target, temporal_split(d, train_before, test_start, test_end).alias("split_group"),
                           d.alias("f_analisis_date"), *rest)


def with_latest_month_oot(df: DataFrame, date_col: str = "f_analisis", test_fraction_col: str | None = None,
                          source: str = "var_rta", target: str = "target_final") -> DataFrame:
    """OOT = the latest calendar month present (X8); earlier rows keep the hash split given in
    ``test_fraction_col`` when provided, else TRAIN.

    The latest month is a scalar subquery (one small aggregate), not a join.  A missing or
    malformed date gets a NULL split, as in the temporal split.
    """
    labelled = add_label(df, source, target)
    month = F.trunc(F.col(date_col).try_cast("date"), "month")
    # from the date column alone: the label and the other columns are not computed for it
    latest = df.select(F.max(month)).scalar()
    base = F.col(test_fraction_col) if test_fraction_col else F.lit("TRAIN")
    return labelled.withColumn("split_group", F.when(month.isNull(), F.lit(None).cast("string")).when(month == latest, "OOT").otherwise(base))


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split (A1)."""
    return df.groupBy("split_group").agg(F.count(F.lit(1)).alias("n")).orderBy("split_group")


def target_distribution(df: DataFrame, target: str = "target_final") -> DataFrame:
    """Rows per target value (A2)."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy(target)


def require_splits(df: DataFrame, splits=("TRAIN", "TEST", "OOT")) -> dict[str, int]:
    """One grouped count; raises when any split is empty (V3)."""
    counts = {r["split_group"]: r["n"] for r in split_counts(df).collect()}
    empty = [s for s in splits if counts.get(s, 0) == 0]
    if empty:
        raise ValueError(f"empty split(s): {empty}")
    return counts
