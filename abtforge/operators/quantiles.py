"""Exact interpolated quantiles: a sketch brackets every rank, a second scan resolves it.

Spark's ``percentile`` is exact but merges every distinct value of a column into one buffer in one
task.  Here the values themselves are hardly shuffled at all:

1. one scan keeps one mergeable quantile sketch per column (``percentile_approx``: bounded memory,
   rank error at most n / accuracy) and reads from it, for every wanted quantile, a value expected
   below and one expected above the rank;
2. a second scan counts what lies below and above each bracket and keeps only the distinct values
   inside it, with counts - about 4 / accuracy of the rows - by map-side sums;
3. the values of a bracket are ranked: range-partitioned into slices, tagged (``checkpoint`` fixes
   the tag), running counts inside each slice plus the counts of all earlier slices;
4. the counts prove each bracket: a rank that lies outside, whatever the sketch promised, is resolved
   by one more scan with the side it lies on as its bracket.

Without further groups both scans take whole columns at a time (Arrow batches, sorted by numpy) instead of
one row per value: a task keeps a thinned copy of each column for step 1 and the cells of step 2.

Interpolation is ``(hi - pos) * v_lo + (pos - lo) * v_hi`` as in Spark's ``percentile`` and other
SQL engines' continuous quantile.  NULL values are ignored; a group without values gets no row.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtforge.session import ensure_checkpoint_dir

ACCURACY = 10_000


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., _position, value DOUBLE) for the non-NULL values of ``cols``, from one scan."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    return df.select(*by, F.posexplode(values).alias("_position", "value")).filter(F.col("value").isNotNull())


def brackets(long: DataFrame, by: Sequence[str], qs: Sequence[float], accuracy: int = ACCURACY, **more) -> DataFrame:
    """(by..., _position, _brackets, more...): an array of (q, lo, hi) around each wanted rank, and any
    further aggregates of ``value`` that the same scan can give.  A small written table: groups x
    quantiles."""
    ensure_checkpoint_dir(long.sparkSession)
    slack = 2.0 / accuracy
    ranks = [min(1.0, max(0.0, q + side * slack)) for side in (-1, 1) for q in qs]
    found = long.groupBy(*by, "_position").agg(F.percentile_approx("value", F.array(*map(F.lit, ranks)), accuracy).alias("_at"), *[c.alias(n) for n, c in more.items()])
    each = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col("_at")[i].alias("lo"), F.col("_at")[i + len(qs)].alias("hi")) for i, q in enumerate(qs)])
    return found.withColumn("_brackets", each).drop("_at").checkpoint(eager=True)


def bracketed_distribution(long: DataFrame, bounds: DataFrame, by: Sequence[str], slices: int | None = None) -> DataFrame:
    """(by..., _position, q, cell, value, _c, _slice): per quantile the distinct values inside its bracket
    (cell 1), and one row each for all values below (0, as their maximum) and above (2, as their minimum).

    The two outer rows also stand for the neighbour just outside the bracket, which an
    interpolated rank may need.  A NULL end of a bracket is open.
    """
    keys = [*by, "_position"]
    most = bounds.select(F.max(F.size("_brackets"))).first()[0] or 1
    each = range(most)
    bounds = bounds.select(*keys, *[F.get("_brackets", F.lit(i)).alias(f"_x{i}") for i in each])
    bounds = bounds.select(*keys, *[F.col(f"_x{i}.{end}").alias(f"_{end}{i}") for i in each for end in ("q", "lo", "hi")])
    # without further groups the bounds have one row per column
    joined = long.join(bounds if by else F.broadcast(bounds), keys)
    cell = lambda i: F.when(F.col("value") < F.col(f"_lo{i}"), 0).when(F.col("value") > F.col(f"_hi{i}"), 2).otherwise(1)
    placed = joined.select(*keys, "value", *[F.col(f"_q{i}") for i in each], *[cell(i).alias(f"_cell{i}") for i in each])
    # one row per value into the first aggregate; only what it leaves is looked at per quantile
    inside = reduce(Column.__or__, [(F.col(f"_cell{i}") == 1) & F.col(f"_q{i}").isNotNull() for i in each], F.lit(False))
    first = placed.groupBy(*keys, *[f"_q{i}" for i in each], *[f"_cell{i}" for i in each], F.when(inside, F.col("value")).alias("_value")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("value").alias("_max"), F.min("value").alias("_min"))
    per = F.array(*[F.struct(F.col(f"_q{i}").alias("q"), F.col(f"_cell{i}").alias("cell")) for i in each])
    cells = first.select(*keys, "_value", "_c", "_max", "_min", F.explode(per).alias("x")).where("x.q IS NOT NULL")
    counted = cells.groupBy(*keys, "x.q", "x.cell", F.when(F.col("x.cell") == 1, F.col("_value")).alias("_in")).agg(
        F.sum("_c").alias("_c"), F.max("_max").alias("_max"), F.min("_min").alias("_min"))
    return _sliced(counted, keys, slices)


def _sliced(counted: DataFrame, keys: Sequence[str], slices: int | None) -> DataFrame:
    """The cells of a bracket scan as (keys..., q, cell, value, _c, _slice), range-partitioned and tagged."""
    value = F.when(F.col("cell") == 0, F.col("_max")).otherwise(F.col("_min"))
    dist = counted.select(*keys, "q", "cell", value.alias("value"), "_c")
    order = [F.col(k) for k in (*keys, "q", "value", "cell")]
    ranged = dist.repartitionByRange(slices, *order) if slices else dist.repartitionByRange(*order)
    return ranged.withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True)


def ranked_quantiles(dist: DataFrame, keys: Sequence[str], interpolate: bool = True) -> DataFrame:
    """(keys..., q, value, _side): the interpolated value at rank q * (n - 1) of each distribution, or
    without ``interpolate`` the value at the rank below.

    ``_side`` is -1 or 1 where the rank lies below or above its bracket, so that the value is not proven.
    """
    groups = [*keys, "q"]
    inside = Window.partitionBy(*groups, "_slice").orderBy("value", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = dist.groupBy(*groups, "_slice").agg(F.sum("_c").alias("_st"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_slice", F.coalesce(F.sum("_st").over(before), F.lit(0)).alias("_off"),
                            F.sum("_st").over(Window.partitionBy(*groups)).alias("_n"))
    placed = dist.withColumn("_cum", F.sum("_c").over(inside)).join(offsets, [*groups, "_slice"])
    pos = (F.col("_n") - 1).cast("double") * F.col("q")
    end = F.col("_off") + F.col("_cum")
    holds = lambda rank: (rank >= end - F.col("_c")) & (rank < end)
    beyond = lambda cell: F.coalesce(F.sum(F.when(F.col("cell") == cell, F.col("_c"))), F.lit(0))
    found = placed.groupBy(*groups).agg(F.max(pos).alias("_pos"), F.max(F.when(holds(F.floor(pos)), F.col("value"))).alias("_vlo"),
                                        F.max(F.when(holds(F.ceil(pos)), F.col("value"))).alias("_vhi"),
                                        F.max("_n").alias("_n"), beyond(0).alias("_below"), beyond(2).alias("_above"))
    p = F.col("_pos")
    lo, hi = F.floor(p), F.ceil(p)
    value = F.col("_vlo") if not interpolate else F.when(lo == hi, F.col("_vlo")).otherwise((hi - p) * F.col("_vlo") + (p - lo) * F.col("_vhi"))
    side = F.when(lo < F.col("_below") - 1, -1).when(hi > F.col("_n") - F.col("_above"), 1).otherwise(0)
    return found.select(*groups, value.cast("double").alias("value"), side.alias("_side"))


def proven_quantiles(long: DataFrame, bounds: DataFrame, by: Sequence[str], slices: int | None = None, interpolate: bool = True) -> DataFrame:
    """(by..., _position, q, value): ranks outside their bracket are resolved again, on the side they lie on."""
    keys = [*by, "_position"]
    found = ranked_quantiles(bracketed_distribution(long, bounds, by, slices), keys, interpolate).checkpoint(eager=True)
    missed = found.where("_side <> 0")
    if missed.isEmpty():
        return found.drop("_side")
    each = bounds.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], F.explode("_brackets").alias("_x"))
    same = [F.col(k).eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)]
    open_side = F.struct(F.col("q"), F.when(F.col("_side") > 0, F.col("_x.hi")).alias("lo"), F.when(F.col("_side") < 0, F.col("_x.lo")).alias("hi"))
    wider = missed.join(each, reduce(Column.__and__, same, F.col("q") == F.col("_x.q")))
    wider = wider.groupBy(*keys).agg(F.collect_list(open_side).alias("_brackets"))
    again = ranked_quantiles(bracketed_distribution(long, wider, by, slices), keys, interpolate)
    return found.where("_side = 0").drop("_side").unionByName(again.drop("_side"))


# Entries of all thinned columns of a task, and cells before it hands them on.
THINNED_AT, CELLS_AT = 1 << 21, 1 << 20


def _cuts(qs: Sequence[float], accuracy: int) -> list[float]:
    """Ranks in (0, 1) at which a sorted column is cut: even steps, and ever finer ones towards each wanted rank."""
    near = [k / (4.0 * accuracy) for k in range(17)]
    while near[-1] < 1.0:
        near.append(near[-1] * 1.05)
    coarse = min(1000, accuracy)
    at = {k / coarse for k in range(1, coarse)} | {q + side * d for q in qs for side in (-1, 1) for d in near}
    return sorted(x for x in at if 0.0 < x < 1.0)


def _columns(width: int):
    """Function of a batch whose only column is an array of ``width`` numbers per row: each number's column without
    NULLs.  A nested function, so that it travels with the task."""
    def columns(batch) -> Iterator:
        import numpy as np

        flat = batch.column(0).flatten()
        values = np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).reshape(-1, width).T)
        if not flat.null_count:
            return iter(values)
        there = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width).T
        return (v[known] for v, known in zip(values, there))

    return columns


def _thinning(width: int, cuts: Sequence[float], most: int):
    """mapInArrow body: per column the task's (_position, value, _w): one value for each run of neighbours, with their number."""
    columns = _columns(width)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ranks, ends = np.array(cuts), {}
        share = max(most // width, 2 * len(cuts))
        kept = [[] for _ in range(width)]
        size = [0] * width

        def thinned(v, w):  # v in order
            upto = np.cumsum(w)
            start = np.unique(np.concatenate(([0], np.searchsorted(upto, ranks * upto[-1]))))
            return v[(start + np.append(start[1:], len(v)) - 1) // 2], np.add.reduceat(w, start)

        def merged(i):
            v, w = (np.concatenate(x) for x in zip(*kept[i]))
            order = np.argsort(v, kind="stable")
            return thinned(v[order], w[order])

        for batch in batches:
            for i, v in enumerate(columns(batch)):
                v = np.sort(v)
                if not len(v):
                    continue
                if len(v) not in ends:
                    ends = {len(v): thinned(np.arange(len(v)), np.ones(len(v), np.int64))}
                at, w = ends[len(v)]
                kept[i].append((v[at], w))
                size[i] += len(at)
                if size[i] > share:
                    kept[i] = [merged(i)]
                    size[i] = len(kept[i][0][0])
        for i in range(width):
            if kept[i]:
                v, w = merged(i)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(w)], ["_position", "value", "_w"])

    return run


def _around(qs: Sequence[float], slack: float):
    """applyInArrow body: (_position, q, lo, hi) of one column from the thinned copies of all tasks."""
    def run(table):
        import numpy as np
        import pyarrow as pa

        v, w = (table.column(c).to_numpy() for c in ("value", "_w"))
        order = np.argsort(v, kind="stable")
        v, upto = v[order], np.cumsum(w[order])
        at = lambda rank, more: v[np.clip(np.searchsorted(upto, rank * upto[-1]) + more, 0, len(v) - 1)]
        q = np.array(qs)
        return pa.table({"_position": pa.array(np.full(len(q), table.column("_position")[0].as_py(), np.int32)), "q": pa.array(q), "lo": pa.array(at(q - slack, -1)), "hi": pa.array(at(q + slack, 1))})

    return run


def _cells(width: int, wanted: Mapping[int, Sequence[tuple]], most: int):
    """mapInArrow body: (_position, q, cell, value, _c) as in ``bracketed_distribution``, summed per task."""
    columns = _columns(width)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        each = [(i, *x) for i, several in sorted(wanted.items()) for x in several]
        below, above = [[0, None] for _ in each], [[0, None] for _ in each]
        inside, pending = [[] for _ in each], 0

        def rows(k, cell, v, c):
            i, q = each[k][:2]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(np.full(len(v), q)), pa.array(np.full(len(v), cell, np.int32)), pa.array(v, pa.float64()), pa.array(c, pa.int64())],
                                              ["_position", "q", "cell", "value", "_c"])

        def found():
            for k, parts in enumerate(inside):
                if parts:
                    v, c = (np.concatenate(x) for x in zip(*parts))
                    v, back = np.unique(v, return_inverse=True)
                    yield rows(k, 1, v, np.bincount(back, weights=c).astype(np.int64))
                    parts.clear()

        of = [[k for k, x in enumerate(each) if x[0] == i] for i in range(width)]
        for batch in batches:
            for k, v in ((k, v) for i, v in enumerate(columns(batch)) if of[i] for v in [np.sort(v) + 0.0] for k in of[i]):
                # sorted, NaN last; 0.0 makes -0.0 the same value
                lo, hi = each[k][2:]
                a = 0 if lo is None else int(np.searchsorted(v, lo, "left"))
                b = len(v) if hi is None else max(a, int(np.searchsorted(v, hi, "right")))
                if a:
                    below[k] = [below[k][0] + a, v[a - 1] if below[k][1] is None else np.sort([below[k][1], v[a - 1]])[1]]
                if b < len(v):
                    above[k] = [above[k][0] + len(v) - b, v[b] if above[k][1] is None else np.sort([above[k][1], v[b]])[0]]
                if a < b:
                    start = np.concatenate(([0], np.flatnonzero(v[a + 1:b] != v[a:b - 1]) + 1))
                    inside[k].append((v[a:b][start], np.diff(np.append(start, b - a))))
                    pending += len(start)
            if pending > most:
                yield from found()
                pending = 0
        yield from found()
        for cell, sides in ((0, below), (2, above)):
            for k, (n, value) in enumerate(sides):
                if n:
                    yield rows(k, cell, [value], [n])

    return run


def _column_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], slices: int | None = None, accuracy: int = ACCURACY,
                      interpolate: bool = True) -> list[tuple[str, float, float]]:
    """(column, q, value): brackets and cells from two scans that take a column of a batch at a time.

    The brackets and what they prove, columns x quantiles numbers, reach the driver; the cells do not.
    """
    ensure_checkpoint_dir(df.sparkSession)
    qs, keys = [float(q) for q in dict.fromkeys(qs)], ["_position"]
    # one array per row crosses to the tasks' Python faster than a column each
    values = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("_values"))
    thin = values.mapInArrow(_thinning(len(cols), _cuts(qs, accuracy), THINNED_AT), "_position int, value double, _w long")
    ends = thin.groupBy("_position").applyInArrow(_around(qs, 2.0 / accuracy), "_position int, q double, lo double, hi double").collect()

    def resolved(wanted: Mapping[tuple, tuple]) -> list:
        at: dict[int, list[tuple]] = {}
        for (i, q), (lo, hi) in wanted.items():
            at.setdefault(i, []).append((q, lo, hi))
        cells = values.mapInArrow(_cells(len(cols), at, CELLS_AT), "_position int, q double, cell int, value double, _c long")
        counted = cells.groupBy("_position", "q", "cell", F.when(F.col("cell") == 1, F.col("value")).alias("_in")).agg(
            F.sum("_c").alias("_c"), F.max("value").alias("_max"), F.min("value").alias("_min"))
        return ranked_quantiles(_sliced(counted, keys, slices), keys, interpolate).collect() if at else []

    bounds = {(r["_position"], r["q"]): (r["lo"], r["hi"]) for r in ends}
    found = resolved(bounds)
    open_side = lambda lo, hi, side: (hi, None) if side > 0 else (None, lo)
    missed = {(r["_position"], r["q"]): open_side(*bounds[r["_position"], r["q"]], r["_side"]) for r in found if r["_side"]}
    return [(cols[r["_position"]], r["q"], r["value"]) for r in [*(r for r in found if not r["_side"]), *resolved(missed)]]


def _named(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "_position int, column_name string")
    return df.join(names, "_position").drop("_position")


def quantile_summary(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (), slices: int | None = None,
                     accuracy: int = ACCURACY, **more) -> tuple[DataFrame, DataFrame]:
    """((by..., column_name, more...), (by..., column_name, q, value)) from two scans of ``df``."""
    by, cols = list(by), list(cols)
    long = long_values(df, cols, by)
    bounds = brackets(long, by, qs, accuracy, **more)
    found = proven_quantiles(long, bounds, by, slices)
    return _named(bounds.drop("_brackets"), cols), _named(found, cols)


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (),
                    slices: int | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """(by..., column_name, q, value) for every column and quantile."""
    if cols and not by:
        return df.sparkSession.createDataFrame(_column_quantiles(df, list(cols), qs, slices, accuracy), "column_name string, q double, value double")
    return quantile_summary(df, cols, qs, by, slices, accuracy)[1].select(*by, "column_name", "q", "value")


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """{column: lower median} (the value at rank ceil(n / 2)) of the values that are neither NULL nor NaN; a
    column without any is left out.  One number per column reaches the driver."""
    cols = list(cols)
    if not cols:
        return {}
    number = lambda c: F.col(f"`{c}`").cast("double")
    present = df.select(*[F.when(~F.isnan(number(c)), number(c)).alias(f"_{i}") for i, c in enumerate(cols)])
    names = dict(zip(present.columns, cols))
    return {names[c]: value for c, _, value in _column_quantiles(present, present.columns, [0.5], interpolate=False)}


def approximate_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], accuracy: int, **more) -> DataFrame:
    """(column_name, _q array, more...) from one scan with bounded memory."""
    wanted = F.percentile_approx("value", F.array(*[F.lit(q) for q in qs]), accuracy)
    out = long_values(df, list(cols)).groupBy("_position").agg(wanted.alias("_q"), *[c.alias(n) for n, c in more.items()])
    return _named(out, cols)


def pivot_quantiles(qdf: DataFrame, groups: Sequence[str], qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One column per quantile (names in the order of ``qs``)."""
    return qdf.groupBy(*groups).agg(*[F.max(F.when(F.col("q") == F.lit(float(q)), F.col("value"))).alias(n)
                                      for q, n in zip(qs, names)])
