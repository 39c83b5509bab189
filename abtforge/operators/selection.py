"""Choosing columns of a very wide table: screen, correlations of all pairs, redundancy.

One scan gives everything.  A task turns its rows into matrices and adds up, for all pairs of columns,
the sums over the rows where both are known (pairwise complete): four matrix products per batch.  At
its end it emits one row per pair of column blocks, with count, means and centred moments, so the
shuffle is (tasks x columns^2), whatever the rows; the scan is coalesced to at most as many tasks as the
cluster has cores.  Partial moments are merged pairwise in two levels, so no task holds many of them.

Sums are taken around a middle value of the task's first rows and merged as centred moments: a small
spread around a large value keeps its digits, and a constant column has none.

Memory: 32 bytes x columns^2 per task (512 MB for 4,000 columns), and block^2 x 48 bytes per merged row.

Defined results: NULL, NaN, infinite values and text that is no number are unknown; a pair without two common rows, or
with a constant side, has no correlation; a table without rows chooses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128
SALTS = 64
_MOMENTS = "a int, b int, salt int, moments binary"


def _merge(one: np.ndarray | None, other: np.ndarray) -> np.ndarray:
    """Moments (n, mean x, mean y, Mxx, Myy, Mxy) of two disjoint sets of rows, elementwise."""
    if one is None:
        return other
    n = one[0] + other[0]
    share = np.divide(other[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = other[1] - one[1], other[2] - one[2]
    weight = one[0] * share
    return np.stack([n, one[1] + dx * share, one[2] + dy * share, one[3] + other[3] + dx * dx * weight,
                     one[4] + other[4] + dy * dy * weight, one[5] + other[5] + dx * dy * weight])


def _middle(rows: np.ndarray, there: np.ndarray) -> np.ndarray:
    """A value from the middle of every column (0 where all are unknown): constant columns have no spread around it."""
    ordered = np.sort(np.where(there, rows, np.inf), axis=0)
    middle = ordered[np.maximum(there.sum(axis=0) - 1, 0) // 2, np.arange(rows.shape[1])]
    return np.where(np.isfinite(middle), middle, 0.0)


def _spread(squares: np.ndarray, explained: np.ndarray) -> np.ndarray:
    """Squares around the mean; what is left by rounding only counts as none."""
    rest = squares - explained
    return np.where(rest <= 1e-12 * squares, 0.0, rest)


def _block_moments(width: int, block: int):
    """mapInArrow body: the task's moments of every pair of column blocks, and a row of its non-zero counts (a = -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        n, sx, sxx, sxy = (np.zeros((width, width)) for _ in range(4))
        nonzero = np.zeros(width)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
            for rows in np.array_split(values, max(1, len(values) // 1024)):
                if not len(rows):
                    continue
                there = np.isfinite(rows)
                nonzero += (there & (rows != 0)).sum(axis=0)
                if centre is None:
                    centre = _middle(rows, there)
                x, mask = np.where(there, rows - centre, 0.0), there.astype(np.float64)
                n += mask.T @ mask
                sx += x.T @ mask     # [i, j]: sum of column i where j is known
                sxx += (x * x).T @ mask
                sxy += x.T @ x
        if centre is None:
            return
        cuts = range(0, width, block)
        salt = (TaskContext.get().partitionId() if TaskContext.get() else 0) % SALTS
        yield pa.RecordBatch.from_pylist([{"a": -1, "b": -1, "salt": salt, "moments": nonzero.tobytes()}], _SCHEMA)
        for a in cuts:
            for b in cuts[a // block:]:
                i, j = slice(a, a + block), slice(b, b + block)
                count, x, y = n[i, j], sx[i, j], sx[j, i].T
                mx, my = (np.divide(v, count, out=np.zeros_like(v), where=count > 0) for v in (x, y))
                found = np.stack([count, (mx + centre[i, None]) * (count > 0), (my + centre[None, j]) * (count > 0),
                                  _spread(sxx[i, j], x * mx), _spread(sxx[j, i].T, y * my), sxy[i, j] - x * my])
                yield pa.RecordBatch.from_pylist([{"a": a // block, "b": b // block, "salt": salt, "moments": found.tobytes()}], _SCHEMA)

    return run


_SCHEMA = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("salt", pa.int32()), ("moments", pa.binary())])


def _merged(width: int, block: int):
    """Grouped body: the moments of one pair of blocks added up, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key = None, None
        for batch in batches:
            for r in batch.select(["a", "b", "moments"]).to_pylist():
                key = (r["a"], r["b"])
                part = np.frombuffer(r["moments"])
                if key[0] < 0:
                    total = part if total is None else total + part
                else:
                    rows, columns = (min(block, width - k * block) for k in key)
                    total = _merge(total, part.reshape(6, rows, columns))
        yield pa.RecordBatch.from_pylist([{"a": key[0], "b": key[1], "salt": 0, "moments": total.tobytes()}], _SCHEMA)

    return run


def _pairs(width: int, block: int):
    """mapInArrow body: (a, b, n, corr) per pair of columns, and (a, a, n, ...) with what the screen needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["a"] < 0:
                    zeros = np.frombuffer(r["moments"])
                    at = np.arange(width)
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.full(width, -1), pa.int32()), pa.array(zeros.astype(np.int64)),
                                                      pa.nulls(width, pa.float64()), pa.nulls(width, pa.float64())], _PAIR_NAMES)
                    continue
                rows, columns = (min(block, width - k * block) for k in (r["a"], r["b"]))
                n, _, _, mxx, myy, mxy = np.frombuffer(r["moments"]).reshape(6, rows, columns)
                i, j = np.meshgrid(np.arange(rows) + r["a"] * block, np.arange(columns) + r["b"] * block, indexing="ij")
                keep = i <= j
                scale = np.sqrt(np.maximum(mxx, 0)) * np.sqrt(np.maximum(myy, 0))
                sound = (scale > 0) & (n > 1)
                corr = np.clip(np.divide(mxy, scale, out=np.zeros_like(mxy), where=sound), -1, 1)
                variance = np.divide(mxx, n - 1, out=np.zeros_like(mxx), where=n > 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()), pa.array(n[keep].astype(np.int64)),
                     pa.array(corr[keep], mask=~sound[keep]), pa.array(variance[keep], mask=~(n > 1)[keep])], _PAIR_NAMES)

    return run


_PAIR_NAMES = ["a", "b", "n", "corr", "variance"]


def pair_statistics(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, n, corr, variance) by column position, for all a <= b, from one scan.

    ``n`` counts the common rows; ``variance`` is that of ``a`` over them.  Rows (a, -1) hold in ``n`` the
    non-zero values of column ``a``.
    """
    width = len(cols)
    values = F.array(*[F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(float("nan"))) for c in cols])
    scan = df.select(values.alias("values")).coalesce(df.sparkSession.sparkContext.defaultParallelism)
    parts = scan.mapInArrow(_block_moments(width, block), _MOMENTS)
    some = parts.groupBy("a", "b", "salt").applyInArrow(_merged(width, block), _MOMENTS)
    whole = some.groupBy("a", "b").applyInArrow(_merged(width, block), _MOMENTS)
    return whole.mapInArrow(_pairs(width, block), "a int, b int, n long, corr double, variance double")


def correlation_pairs(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(column_a, column_b, n, corr) for every pair of columns, in the order of ``cols``; pairwise complete."""
    names = F.array(*[F.lit(c) for c in cols])
    found = pair_statistics(df, cols, block).where("a < b AND b >= 0")
    return found.select(F.get(names, F.col("a")).alias("column_a"), F.get(names, F.col("b")).alias("column_b"), "n", "corr")


def greedy_choice(order: Sequence[int], alike: dict[int, list[int]], least: int, most: int) -> dict[int, int | None]:
    """Columns in ``order``, each with the chosen column that makes it redundant (None if chosen).

    A column is chosen unless an earlier chosen one is like it, until ``most`` are chosen; if these are
    fewer than ``least``, the first redundant ones are chosen too.
    """
    chosen: list[int] = []
    out: dict[int, int | None] = {}
    place = {c: k for k, c in enumerate(order)}
    taken: set[int] = set()
    for c in order:
        if len(chosen) >= most:
            break
        near = [x for x in alike.get(c, ()) if x in taken]
        out[c] = min(near, key=place.__getitem__) if near else None
        if not near:
            chosen.append(c)
            taken.add(c)
    for c in order:
        if len(taken) >= min(least, most):
            break
        if c in out and out[c] is not None:
            out[c] = None
            taken.add(c)
    return out


def choose_columns(df: DataFrame, cols: Sequence[str], target: str | None = None, alike: float = 0.95, least: int = 120, most: int = 150,
                   min_nonzero_rate: float = 0.01, min_variance: float = 0.0, min_common: int = 30, block: int = BLOCK) -> DataFrame:
    """(place, column_name, score, n, nonzero_rate, verdict, like): one row per column of ``cols``.

    ``verdict`` is ``chosen``, ``redundant`` (``like`` names the chosen column with an absolute correlation of at least
    ``alike`` over at least ``min_common`` common rows), ``screened`` (too few non-zero values, or constant) or ``beyond`` (after the
    ``most``-th).  Columns go by score, then name: the absolute correlation with ``target`` if there is one, else the
    share of non-zero values; both rounded to 9 digits, so that columns which differ by rounding only go by name.

    The driver holds one row per column and the pairs that are alike: at most columns^2 / 2.
    """
    cols = [c for c in cols if c != target]
    wide = [*cols, target] if target else cols
    spark = df.sparkSession
    schema = "place int, column_name string, score double, n long, nonzero_rate double, verdict string, like string"
    if not cols:
        return spark.createDataFrame([], schema)
    from abtforge.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    stats = pair_statistics(df, wide, block).checkpoint(eager=True)
    last = len(cols)
    own = {r["a"]: r for r in stats.where("a = b").collect()}
    nonzero = {r["a"]: r["n"] for r in stats.where("b = -1").collect()}
    related = {r["a"]: r["corr"] for r in stats.where(F.col("b") == last).where(F.col("a") < last).collect()} if target else {}
    pairs = stats.where((F.col("a") < F.col("b")) & (F.col("b") < last) & (F.abs("corr") >= alike) & (F.col("n") >= min_common)).select("a", "b").toArrow()
    if not own:
        return spark.createDataFrame([], schema)
    near: dict[int, list[int]] = {}
    for a, b in zip(pairs["a"].to_numpy().tolist(), pairs["b"].to_numpy().tolist()):
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    rate = {k: nonzero[k] / own[k]["n"] if own[k]["n"] else 0.0 for k in range(last)}
    sound = [k for k in range(last) if rate[k] >= min_nonzero_rate and (own[k]["variance"] or 0.0) > min_variance]
    score = {k: round(abs(related.get(k) or 0.0) if target else rate[k], 9) for k in range(last)}
    order = sorted(sound, key=lambda k: (-score[k], cols[k]))
    found = greedy_choice(order, near, least, most)
    verdicts = {k: ("screened", None) for k in range(last)} | {k: ("beyond", None) for k in order}
    verdicts |= {k: ("chosen", None) if like is None else ("redundant", cols[like]) for k, like in found.items()}
    place = {k: i + 1 for i, k in enumerate(k for k in order if verdicts[k][0] == "chosen")}
    rows = [(place.get(k), cols[k], float(score[k]), int(own[k]["n"]), float(rate[k]), *verdicts[k]) for k in range(last)]
    return spark.createDataFrame(rows, schema)
