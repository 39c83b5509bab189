"""Feature preparation (P25-P30, M10): coerce, drop empty columns, clip, align.

Fitting happens on TRAIN and produces a *bounds table* (one row per feature: q_low,
q_high); applying it is a projection with literals, so TEST, OOT and scoring batches are
clipped by the same TRAIN bounds.
"""

from __future__ import annotations

from typing import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.functions.numeric import clip, finite_or_null, to_double

# Key, split and target columns, which are never features.
DEFAULT_EXCLUDE = ("num_doc", "obl17", "f_analisis", "split_group", "target_final", "var_rta",
                   "f_analisis_key", "num_doc_key", "obl17_key", "f_analisis_date")


def feature_candidates(columns: Sequence[str], exclude: Sequence[str] = DEFAULT_EXCLUDE,
                       target: str = "target_final") -> list[str]:
    """Feature list by exclusion of keys, split and target."""
    skip = set(exclude) | {target}
    return [c for c in columns if c not in skip]


def coerce_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns unchanged, ``cols`` as DOUBLE with text->number, bad text->NULL,
    +-inf and NaN -> NULL (P25, P26)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.col(k) for k in keep],
                     *[finite_or_null(to_double(F.col(f"`{c}`"), types[c])).alias(c) for c in cols])


def infinite_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_inf): how many +-inf each column holds (text that parses to inf included)."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_inf long")
    types = {f.name: f.dataType for f in df.schema.fields}
    conv = df.select(F.array(*[to_double(F.col(f"`{c}`"), types[c]) for c in cols]).alias("_values"))
    found = conv.mapInArrow(_infinite(len(cols)), "_position int, n long").groupBy("_position").agg(F.sum("n").alias("n_inf"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "_position int, column_name string")
    return names.join(found, "_position", "left").select("column_name", F.coalesce("n_inf", F.lit(0).cast("long")).alias("n_inf"))


def _infinite(width: int):
    """mapInArrow body: how many +-inf the task's rows hold per column."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        n = np.zeros(width, np.int64)
        for batch in batches:
            n += np.isinf(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(n)], ["_position", "n"])

    return run


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns without a single non-NULL value (returns names only)."""
    from abtforge.operators.columnwise import column_stats

    if not cols:
        return []
    rows = column_stats(df, cols, {"n": lambda x: F.count_if(x)}, value=F.isnotnull, empty={"n": 0}).collect()
    empty = {r["column_name"] for r in rows if r["n"] == 0}
    return [c for c in cols if c in empty]


def quantile_bounds(df: DataFrame, cols: Sequence[str], q_low: float = 0.001, q_high: float = 0.999,
                    exact: bool = True, accuracy: int = 100000, slices: int | None = None) -> DataFrame:
    """(column_name, q_low, q_high) per column, kept only when both exist and q_high > q_low.

    Exact interpolated quantiles from two scans (``quantiles.exact_quantiles``: no column's values
    are shuffled or gathered in one task); ``exact=False`` uses one ``percentile_approx`` per column
    with bounded memory.
    """
    from abtforge.operators import quantiles as Q

    spark = df.sparkSession
    cols = list(cols)
    if not cols:
        return spark.createDataFrame([], "column_name string, q_low double, q_high double")
    if exact:
        out = Q.pivot_quantiles(Q.exact_quantiles(df, cols, [q_low, q_high], slices=slices), ["column_name"],
                                [q_low, q_high], ["q_low", "q_high"])
    else:
        out = Q.approximate_quantiles(df, cols, [q_low, q_high], accuracy).select(
            "column_name", F.col("_q")[0].cast("double").alias("q_low"), F.col("_q")[1].cast("double").alias("q_high"))
    return out.filter(F.col("q_low").isNotNull() & F.col("q_high").isNotNull() & (F.col("q_high") > F.col("q_low")))


def bounds_dict(bounds: DataFrame) -> dict[str, tuple[float, float]]:
    """Bring a bounds table to the driver (one row per feature)."""
    return {r["column_name"]: (r["q_low"], r["q_high"]) for r in bounds.collect()}


def apply_clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clip every column that has bounds; others pass through."""
    return df.select(*[clip(F.col(f"`{c}`"), *bounds[c]).alias(c) if c in bounds else F.col(f"`{c}`")
                       for c in df.columns])


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``features`` in that order: missing -> NULL DOUBLE, extra columns dropped."""
    have = set(df.columns)
    return df.select(*[F.col(k) for k in keep],
                     *[F.col(f"`{c}`") if c in have else F.lit(None).cast("double").alias(c) for c in features])


def sanitize_fit(train: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                 clip_quantiles: tuple[float, float] | None = (0.001, 0.999), exact: bool = True):
    """TRAIN: coerce, drop all-NULL columns, fit clip bounds, clip.

    With clipping on, one quantile pass serves both purposes: a column without any value
    has no quantile, which is how all-NULL columns are found.  Returns (clean DataFrame,
    kept feature list, bounds dict).
    """
    from abtforge.operators import quantiles as Q

    features = list(features)
    coerced = coerce_numeric(train, features, keep)
    bounds: dict = {}
    if clip_quantiles is not None and features:
        q_low, q_high = clip_quantiles
        if exact:
            qdf = Q.pivot_quantiles(Q.exact_quantiles(coerced, features, [q_low, q_high]), ["column_name"],
                                    [q_low, q_high], ["q_low", "q_high"])
        else:
            qdf = (Q.approximate_quantiles(coerced, features, [q_low, q_high], 100000)
                   .select("column_name", F.col("_q")[0].alias("q_low"), F.col("_q")[1].alias("q_high")))
        rows = qdf.collect()
        present = {r["column_name"] for r in rows}
        bounds = {r["column_name"]: (r["q_low"], r["q_high"]) for r in rows
                  if r["q_low"] is not None and r["q_high"] is not None and r["q_high"] > r["q_low"]}
        kept = [c for c in features if c in present]
    else:
        empty = set(all_null_columns(coerced, features))
        kept = [c for c in features if c not in empty]
    coerced = coerced.select(*[F.col(k) for k in keep], *[F.col(f"`{c}`") for c in kept])
    return apply_clip(coerced, bounds), kept, bounds


def sanitize_apply(df: DataFrame, features: Sequence[str], bounds: Mapping[str, tuple[float, float]] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """TEST/OOT/scoring: align to the TRAIN feature list, coerce, clip with TRAIN bounds."""
    aligned = align_features(df, features, keep)
    coerced = coerce_numeric(aligned, list(features), keep)
    return apply_clip(coerced, bounds or {})
