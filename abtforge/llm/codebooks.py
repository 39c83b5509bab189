"""Vector compression: product codebooks whose entries are searched through a GNAT.

Vectors become integers, floor(scale * x) per component, and are cut into equal consecutive parts.
Every part position has a codebook, first the parts of the rows with the smallest ids, then refined:
a round assigns each part to its nearest entry and replaces every used entry by the floored mean of
its parts.  A code is the entry's index per part.

The nearest entry is found in a geometric near-neighbour access tree over the entries.  A node has a
few split points far from each other and gives every other entry to its nearest split point; for
each pair it stores the range of distances from a split point to the entries of a child.  With
``d`` the query's distance to split point i and ``r`` that of the best entry so far, an entry that
is at least as near lies within [d - r, d + r] of the split point, so a child whose range misses this
interval is left out whole.  Square roots and sums are rounded outwards and the range must be missed
strictly, so no entry of equal distance is lost; distances are compared as integers, ties by index.

Data flow: a round is one pass over the table.  The codebooks (``parts`` x ``entries`` entries)
travel with the tasks; each task adds up count and component sums per entry and emits one row per
(part, entry), the only thing that is shuffled; the driver gets one row per entry.  Codes need one
more pass; error sums per label are map-side sums, joined back by broadcast up to ``BROADCAST_LABELS``
labels (counted), else by an ordinary join that AQE splits where a label holds most rows.

Defined results: a vector that is NULL or holds a NULL or non-finite component is dropped.  A NULL id
comes after all others, rows of equal id go by vector; fewer than ``entries`` rows make smaller
codebooks.  The first of these rows sets the length: a vector of another length stays, with NULL
code and error, and takes no part (a label of such rows only has a NULL sum); a length that ``parts`` does not divide gives the first parts one
component more.  Components beyond ``SMALL`` are compared without elimination, as unbounded
integers; errors beyond 64 bits are clipped to them.  Repeated rows count and are coded each; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtforge.llm.store import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4
SMALL = 1 << 26
BROADCAST_LABELS = 100_000
_LONG = (1 << 63) - 1

Codebooks = list[np.ndarray]


def is_sound(vector: Column) -> Column:
    """True for a vector without NULL and non-finite components, and not NULL itself."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _outwards(x: np.ndarray, to: float) -> np.ndarray:
    return np.nextafter(np.nextafter(x, to), to)


def _squares(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    away = points - point
    return (away * away).sum(axis=1)


class Gnat:
    """The tree over the entries ``members`` (ascending indices) of one codebook of small integers."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None, degree: int = DEGREE):
        self.entries = entries
        members = np.arange(len(entries)) if members is None else members
        chosen, apart = [0], [_squares(entries[members], entries[members[0]])]
        while len(chosen) < min(degree, len(members)):
            away = np.min(apart, axis=0)
            away[chosen] = -1
            chosen.append(int(away.argmax()))
            apart.append(_squares(entries[members], entries[members[chosen[-1]]]))
        self.splits = members[chosen]
        self.children: list[Gnat | None] = []
        rest = np.ones(len(members), bool)
        rest[chosen] = False
        if not rest.any():
            return
        squares = np.stack(apart)
        nearest = squares.argmin(axis=0)
        self.low, self.high = np.zeros((2, len(self.splits), len(self.splits)))
        for j in range(len(self.splits)):
            own = rest & (nearest == j)
            self.children.append(Gnat(entries, members[own], degree) if own.any() else None)
            if own.any():
                roots = np.sqrt(squares[:, own].astype(np.float64))
                self.low[:, j] = _outwards(roots.min(axis=1), -np.inf)
                self.high[:, j] = _outwards(roots.max(axis=1), np.inf)

    def search(self, points: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> int:
        """Improve ``best`` (squared distance) and ``at`` (entry) of ``rows``; distances computed."""
        own = points[rows]
        squares = [_squares(own, self.entries[s]) for s in self.splits]
        for s, d in zip(self.splits, squares):
            better = (d < best[rows]) | (d == best[rows]) & (s < at[rows])
            best[rows[better]] = d[better]
            at[rows[better]] = s
        work = len(rows) * len(self.splits)
        if not self.children:
            return work
        roots = [np.sqrt(d.astype(np.float64)) for d in squares]
        for j, child in enumerate(self.children):
            if child is None:
                continue
            radius = _outwards(np.sqrt(best[rows].astype(np.float64)), np.inf)
            alive = np.ones(len(rows), bool)
            for i, root in enumerate(roots):
                least = _outwards(_outwards(root, -np.inf) - radius, -np.inf)
                most = _outwards(_outwards(root, np.inf) + radius, np.inf)
                alive &= (least <= self.high[i, j]) & (most >= self.low[i, j])
            if alive.any():
                work += child.search(points, rows[alive], best, at)
        return work


def nearest_entries(tree: Gnat, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index."""
    if points.dtype != object and tree.entries.dtype != object:
        best, at = np.full(len(points), _LONG), np.full(len(points), len(tree.entries))
        tree.search(points, np.arange(len(points)), best, at)
        return at, best
    best, at = np.full(len(points), None, object), np.zeros(len(points), np.int64)
    for k, entry in enumerate(tree.entries.astype(object)):
        for row, point in enumerate(points.astype(object)):
            d = int(sum((a - b) ** 2 for a, b in zip(point, entry)))
            if best[row] is None or d < best[row]:
                best[row], at[row] = d, k
    return at, best


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): int64 where every component is small, else Python integers."""
    whole = np.floor(vectors * float(scale)) if not vectors.size or np.abs(vectors).max() < SMALL / scale else None
    if whole is not None:
        return whole.astype(np.int64)
    exact = lambda x: (lambda n, d: n * scale // d)(*float(x).as_integer_ratio())
    return np.array([[exact(x) for x in v] for v in vectors], object).reshape(vectors.shape)


def _slices(length: int, parts: int) -> list[slice]:
    cuts = np.r_[0, np.cumsum([len(x) for x in np.array_split(np.arange(length), parts)])]
    return [slice(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


def _same_kind(points: np.ndarray) -> np.ndarray:
    """Object arrays of small integers become int64."""
    small = points.dtype == object and all(abs(x) < SMALL for x in points.flat)
    return points.astype(np.int64) if small else points


def _blocks(batch: pa.RecordBatch, length: int, scale: int, most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of a batch: vectors of the wanted length, small ones apart from others."""
    column = batch["vector"]
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(sizes == length)
    for i in range(0, len(fit), most):
        rows = fit[i:i + most]
        values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)
        large = (np.abs(values) >= SMALL / scale).any(axis=1) if length else np.zeros(len(rows), bool)
        for chosen in (~large, large):
            if chosen.any():
                yield rows[chosen], integers(values[chosen], scale)


def _sum_parts(books: Codebooks, scale: int) -> Callable:
    """mapInArrow body: per (part, entry) the task's count and component sums, as decimal texts."""
    trees, length = [Gnat(b) if b.dtype != object else _Plain(b) for b in books], sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [{np.dtype(np.int64): np.zeros(b.shape, np.int64), np.dtype(object): np.zeros(b.shape, object)} for b in books]
        for batch in batches:
            for _, points in _blocks(batch, length, scale):
                for p, cut in enumerate(_slices(length, len(books))):
                    at, _ = nearest_entries(trees[p], points[:, cut])
                    counts[p] += np.bincount(at, minlength=len(counts[p]))
                    np.add.at(sums[p][points.dtype], at, points[:, cut])
        rows = [(p, k, int(n), [str(int(a) + int(b)) for a, b in zip(*(s[k] for s in sums[p].values()))])
                for p in range(len(books)) for k, n in enumerate(counts[p]) if n]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in
                                          enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())))], ["part", "entry", "n", "sums"])

    return run


class _Plain:
    """Entries beyond the range of the tree."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries


def _add_up(rows: pa.Table) -> pa.Table:
    """The tasks' sums of one entry: its new components, floor(sum / count).  One row per task comes in."""
    n = sum(rows["n"].to_pylist())
    total = [sum(map(int, x)) // n for x in zip(*rows["sums"].to_pylist())]
    return pa.table({"part": rows["part"][:1].combine_chunks(), "entry": rows["entry"][:1].combine_chunks(),
                     "mean": pa.array([[str(x) for x in total]], pa.list_(pa.string()))})


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """The refined codebooks of ``vectors`` (vec_id, vector of doubles, sound only); None without rows."""
    first = [r["vector"] for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()]
    if not first:
        return None
    start = integers(np.array([v for v in first if len(v) == len(first[0])], np.float64).reshape(-1, len(first[0])), scale)
    books = [_same_kind(start[:, cut]) for cut in _slices(len(first[0]), parts)]
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(_sum_parts(books, scale), "part int, entry int, n long, sums array<string>")
        means = sums.groupBy("part", "entry").applyInArrow(_add_up, "part int, entry int, mean array<string>").collect()
        new = [b.astype(object) for b in books]
        for r in means:
            new[r["part"]][r["entry"]] = [int(x) for x in r["mean"]]
        books = [_same_kind(b) for b in new]
    return books


def encode(vectors: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``vectors`` without the vector, with ``code`` and ``error``."""
    trees, length = [Gnat(b) if b.dtype != object else _Plain(b) for b in books], sum(b.shape[1] for b in books)
    kept = [f for f in vectors.schema.fields if f.name != "vector"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            for rows, points in _blocks(batch, length, scale):
                found = [nearest_entries(t, points[:, cut]) for t, cut in zip(trees, _slices(length, len(books)))]
                codes[rows] = [bytes(c).hex() for c in np.stack([at for at, _ in found], axis=1).astype(np.uint8)]
                errors[rows] = [min(int(e), _LONG) for e in sum(d.astype(object) for _, d in found)]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], [*names, "code", "error"])

    return vectors.mapInArrow(run, T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def books_digest(books: Codebooks) -> str:
    """sha256 of all components by part, entry and position, as decimal texts joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.flat).encode()).hexdigest()


def compress_report(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                    broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label: one row per sound row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: entries must be 1 to 256")
    sound = embeddings.where(is_sound(F.col("embedding")))
    vectors = sound.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), "label")
    books = fit_codebooks(vectors.select("vec_id", "vector"), parts, entries, rounds, scale)
    coded = vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")) \
        if books is None else written(encode(vectors, books, scale), "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(exact.isNotNull(), F.least(exact, F.lit(_LONG).cast("decimal(38,0)")).cast("long"))
    labels = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    if books is not None:
        labels = written(labels, "code-labels")
        if labels.count() <= broadcast_labels:
            labels = F.broadcast(labels)
    out = coded.join(labels, coded["label"].eqNullSafe(labels["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books or [])).alias("codebooks_sha256"), "label")
