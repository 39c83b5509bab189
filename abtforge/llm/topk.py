"""Exact top-k inner-product search with ball trees.

Rows are dealt to shards; a task builds one ball tree over its shard and answers blocks of
queries against it.  A node's inner product with a query is at most ``q.centre + |q| * radius``;
blocks descend level by level, visit leaves in descending order of that bound and stop below the
query's current k-th score.  The k-th score is shared between shards: a first pass answers every
query in one shard only (its home), and the k-th score found there - a lower bound of the final
one - travels with the query into every shard of the second pass, so most shards return only rows
that can still win.

Data flow: rows are shuffled once; queries go to all shards in binary blocks, so the second pass
moves (queries x shards) vectors and never a pair.  A task holds one shard and one block.  Nothing
is collected or broadcast.

Defined results: a vector that is NULL, or holds a NULL or non-finite component, takes no part,
nor does a row without id; vectors of different lengths meet as if padded with zeros; repeated
rows are candidates each; rows with a query's own id are not its candidates; a query id on several
rows is asked once, with its smallest vector; scores beyond 64 bits are clipped to them; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtforge.llm.store import written

LEAF = 128
BLOCK = 256
SHARD_ROWS = 1 << 16
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component as long; NULL if any component is NULL or not finite."""
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64 (clipped), by matrix product where doubles are exact."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    size = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max()) * queries.shape[1]
    if size < _EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    wide = queries.astype(object) @ rows.astype(object).T
    return np.clip(wide, -_LONG - 1, _LONG).astype(np.int64)


class BallTree:
    """Complete binary tree of median splits; every level is an array of nodes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids) / leaf)))))
        points = vectors.astype(np.float64)
        order = np.arange(len(ids))
        cuts = np.array([0, len(ids)])
        self.levels = []
        for level in range(depth + 1):
            centres = np.stack([points[order[a:b]].mean(0) if b > a else np.zeros(points.shape[1]) for a, b in zip(cuts, cuts[1:])])
            radii = np.array([np.sqrt(((points[order[a:b]] - c) ** 2).sum(1).max()) if b > a else -np.inf
                              for a, b, c in zip(cuts, cuts[1:], centres)])
            self.levels.append((centres, radii))
            if level == depth:
                break
            parts = [cuts[:1]]
            for a, b, c in zip(cuts, cuts[1:], centres):
                own = points[order[a:b]]
                mid = (a + b) // 2
                if b - a > 1:  # split along the line through two far points
                    one = own[((own - c) ** 2).sum(1).argmax()]
                    other = own[((own - one) ** 2).sum(1).argmax()]
                    order[a:b] = order[a:b][np.argsort(own @ (other - one), kind="stable")]
                parts.append(np.array([mid, b]))
            cuts = np.concatenate(parts)
        self.leaves = []
        for a, b in zip(cuts, cuts[1:]):
            own = np.sort(order[a:b])
            self.leaves.append((ids[own], vectors[own]))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of at most k rows a query, none below its ``kth``."""
        n = len(query_ids)
        floats = queries.astype(np.float64)
        norms = np.sqrt((floats ** 2).sum(1))
        kth = kth.copy()
        alive = np.ones((n, 1), bool)
        for level, (centres, radii) in enumerate(self.levels):
            if level:
                alive = np.repeat(alive, 2, axis=1)
            with np.errstate(invalid="ignore"):
                bound = floats @ centres.T + np.where(np.isfinite(radii), norms[:, None] * np.maximum(radii, 0), -np.inf)
            bound += 1e-9 * (np.abs(bound, where=np.isfinite(bound), out=np.zeros_like(bound)) + 1) + 1e-6
            alive &= bound >= kth[:, None]
        visits = np.argsort(-np.where(alive, bound, -np.inf), axis=1, kind="stable")
        best = np.take_along_axis(np.where(alive, bound, -np.inf), visits, axis=1)
        found = (np.zeros(0, np.int64),) * 3
        for turn in range(visits.shape[1]):
            ask = np.flatnonzero((best[:, turn] >= kth) & np.isfinite(best[:, turn]))
            if not len(ask):
                break
            new = [found]
            leaf_of = visits[ask, turn]
            for leaf in np.unique(leaf_of):
                who = ask[leaf_of == leaf]
                ids, vectors = self.leaves[leaf]
                got = scores(queries[who], vectors)
                q, c = np.nonzero((got >= kth[who][:, None]) & (ids[None, :] != query_ids[who][:, None]))
                new.append((who[q], ids[c], got[q, c]))
            found = keep_best(tuple(np.concatenate(x) for x in zip(*new)), k)
            full = np.bincount(found[0], minlength=n) >= k
            if full.any():
                low = np.full(n, _LONG, np.int64)
                np.minimum.at(low, found[0], found[2])
                kth = np.where(full, np.maximum(kth, low), kth)
        return found


def keep_best(found: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query: score descending, then id."""
    q, ids, score = found
    order = np.lexsort((ids, ~score, q))
    q = q[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    order = order[rank < k]
    return tuple(x[order] for x in found)


def _matrix(flat: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat, np.r_[0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]


_SEARCHED = "query_id long, vec_id long, score long"


def _search_sorted(k: int, leaf: int):
    """mapInArrow body over rows sorted by (shard, part): a shard's rows, then its query blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, tree, width = None, [], None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                at, part = one["shard"][0].as_py(), one["part"][0].as_py()
                if at != shard:
                    shard, rows, tree = at, [], None
                ids = one["ids"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                flat, offsets = _lists(one["vectors"].flatten())
                if part == 0:
                    rows.append((ids, flat, offsets))
                    continue
                if not rows:
                    continue
                if tree is None:
                    width = max(int(np.diff(o).max(initial=0)) for _, _, o in rows)
                    tree = BallTree(np.concatenate([r[0] for r in rows]), np.concatenate([_matrix(f, o, width) for _, f, o in rows]), leaf)
                longest = int(np.diff(offsets).max(initial=0))
                asked = _matrix(flat, offsets, max(longest, width))[:, :width]  # beyond the rows' width all products are 0
                kth = one["kth"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                q, found, score = tree.search(ids, asked, kth, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def _pass(rows: DataFrame, blocks: DataFrame, shards: int, k: int, leaf: int) -> DataFrame:
    both = rows.unionByName(blocks).repartition(shards, "shard").sortWithinPartitions("shard", "part")
    return both.mapInArrow(_search_sorted(k, leaf), _SEARCHED)


def _blocks(queries: DataFrame, block: int, *keys: str) -> DataFrame:
    """Queries in blocks of about ``block`` rows: (keys, part, ids, vectors, kth)."""
    return (queries.groupBy(*keys, "part")
            .agg(F.collect_list(F.struct("vec_id", "vector", "kth")).alias("x"))
            .select(*keys, "part", F.col("x.vec_id").alias("ids"), F.col("x.vector").alias("vectors"), F.col("x.kth").alias("kth")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows by integer inner product.

    ``vectors`` has ``vec_id`` and ``vector`` (array of long, NULL where it takes no part);
    ``is_query`` picks the queries among its rows.
    """
    spark = vectors.sparkSession
    sound = written(vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "vector"), "topk")
    n = sound.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // shard_rows))
    shards = max(1, min(shards, -(-n // (4 * leaf))))
    deal = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    asked = sound.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n_blocks = max(1, -(-asked.count() // block))

    # rows travel in small chunks, so that a shard is a few hundred rows of arrays
    chunk = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(max(1, -(-n // (shards * 256))))).cast("int")
    rows = (sound.select(deal.alias("shard"), chunk.alias("chunk"), "vec_id", "vector").groupBy("shard", "chunk")
            .agg(F.collect_list(F.struct("vec_id", "vector")).alias("x"))
            .select("shard", F.lit(0).alias("part"), F.col("x.vec_id").alias("ids"), F.col("x.vector").alias("vectors"),
                    F.array().cast("array<long>").alias("kth")))
    rows = written(rows, "topk-rows")

    least = F.lit(-_LONG - 1).cast("long")
    home = asked.select("vec_id", "vector", least.alias("kth"), deal.alias("shard"),
                        (F.lit(1) + F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(-(-n_blocks // shards)))).cast("int").alias("part"))
    first = _pass(rows, _blocks(home, block, "shard"), shards, k, leaf)
    bounds = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    kth = F.when(F.col("n") >= k, F.col("low")).otherwise(least)
    known = asked.join(bounds, asked["vec_id"] == bounds["query_id"], "left")
    known = known.select("vec_id", "vector", F.coalesce(kth, least).alias("kth"),
                         (F.lit(1) + F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n_blocks))).cast("int").alias("part"))
    everywhere = _blocks(known, block).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "part", "ids", "vectors", "kth")
    found = _pass(rows, everywhere, shards, k, leaf)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
