"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word pairs and pairs that skip one word of a text, and the
same over word stems (the first ``STEMS`` bytes of longer words): single stems, and a stem with its
2nd to 4th occurrence in the text, a skip-gram of any gap.  There are ``BUCKETS`` of them.  FTRL
keeps two sums per coordinate: its own learning rate and an L1 threshold below which the weight is
exactly zero, so the trained weights are few and are broadcast as a sparse list of at most
``BUCKETS`` entries.

Training runs ``ROUNDS`` passes in a hashed order over a bounded labelled sample, in one task of the
cluster: at most ``SAMPLE`` rows, those with the smallest id hashes, and of these in that order as
many as hold ``FEATURES`` features together (256 MB), so neither the corpus nor the length of its
texts changes the memory.  The state never leaves that task; it returns the non-zero weights.
Scoring is one pass over the texts, no shuffle.

Defined results: NULL and empty texts score as the bias alone; without labelled rows every score
is 0.5; NULL ids are scored, and are not held out; repeated rows score alike; very long texts are
scored whole, in linear work, and are left out of the sample only beyond ``FEATURES``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtforge.llm.samples import fold, labelled_sample
from abtforge.llm.store import written
from abtforge.llm.textarrays import ALNUM, Block, blocks, lower_ascii, mix, prefix_hash, span_hash, words

BUCKETS = 1 << 22
SAMPLE = 16384
FEATURES = 1 << 26
STEMS = (6, 7, 8)
ROUNDS = 5
ALPHA, BETA, L1, L2 = 1.5, 1.0, 6.0, 0.1
TOXIC_WEIGHT = 1.5
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7


def occurrences(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each hash stands in its row, counted along the array (from 0)."""
    order = np.lexsort((h, row))
    first = np.ones(len(h), bool)
    first[1:] = (np.diff(row[order]) != 0) | (h[order][1:] != h[order][:-1])
    at = np.arange(len(h))
    out = np.empty(len(h), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def block_features(block: Block, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word, word pair, skip pair and stem of a block, repeats included."""
    data = lower_ascii(block.data)
    start, end, row = words(data, block.offsets, ALNUM)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = prefix_hash(data)
    h = span_hash(prefix, start, end)
    rows, grams = [row], [h]
    for step, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        same = row[step:] == row[:-step]
        rows.append(row[step:][same])
        grams.append(mix(h[:-step][same] * np.uint64(salt) + h[step:][same]))
    for size in STEMS:
        longer = end - start > size
        stem = span_hash(prefix, start[longer], start[longer] + size)
        nth = occurrences(row[longer], stem)
        early = nth < 4
        rows.append(row[longer][early])
        grams.append(mix(stem[early] + np.uint64(0x8EBC6AF09C88C6E3) * (nth[early] + 1).astype(np.uint64)))
    return np.concatenate(rows), (np.concatenate(grams) % np.uint64(buckets)).astype(np.int64)


def ftrl_weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray | float = L1) -> np.ndarray:
    """Weights of a state: zero within the L1 threshold, else with each coordinate's own rate."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


class Ftrl:
    """Per-coordinate state (z, n) of FTRL-proximal; the last coordinate is the bias, without L1."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def learn(self, features: np.ndarray, y: float) -> None:
        at = np.append(features, len(self.z) - 1)
        l1 = np.full(len(at), L1)
        l1[-1] = 0
        w = ftrl_weights(self.z[at], self.n[at], l1)
        gradient = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (TOXIC_WEIGHT if y else 1.0)
        sigma = (np.sqrt(self.n[at] + gradient ** 2) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient ** 2


def _learn(rounds: int, buckets: int):
    """Grouped body: FTRL over the sample, ``rounds`` times in a hashed order; the non-zero weights."""

    def run(rows: pa.Table) -> pa.Table:
        model = Ftrl(np.zeros(buckets + 1), np.zeros(buckets + 1))
        ids, ys, xs = rows["doc_id"].to_numpy(), rows["y"].to_numpy(), rows["x"].combine_chunks()
        for turn in range(rounds):
            mixed = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(turn + 1))
            for i in np.lexsort((ids, mixed)):
                model.learn(xs[int(i)].values.to_numpy().astype(np.int64), float(ys[i]))
        l1 = np.where(np.arange(buckets + 1) == buckets, 0.0, L1)
        w = ftrl_weights(model.z, model.n, l1)
        hit = np.flatnonzero(w)
        return pa.table({"bucket": hit, "weight": w[hit]})

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, folds: int = FOLDS,
          held_out: int = HELD_OUT, buckets: int = BUCKETS, features_limit: int = FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets with weight in order, their weights, bias) from at most ``sample`` labelled rows.

    Only the non-zero weights come to the driver: at most one per bucket.
    """
    chosen = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), folds) == held_out, sample)

    @F.arrow_udf("array<int>")
    def features(text: pa.Array) -> pa.Array:
        out = []
        for block in blocks(text):
            row, bucket = block_features(block, buckets)
            pair = np.unique(row * buckets + bucket)
            cut = np.searchsorted(pair // buckets, np.arange(block.rows + 1))
            out += [(pair[a:b] % buckets).astype(np.int32) for a, b in zip(cut, cut[1:])]
        return pa.array(out, pa.list_(pa.int32()))

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "y", features(F.col("text")).alias("x"))
            .groupBy("doc_id").agg(F.max("y").alias("y"), F.max("x").alias("x")))
    rows = written(rows, "toxicity")
    # the ids are at most ``sample`` rows, so one window task can add up their features
    so_far = F.sum(F.size("x").cast("long")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    fit = rows.select("doc_id", so_far.alias("upto")).where(F.col("upto") <= features_limit).select("doc_id")
    learned = rows.join(F.broadcast(fit), "doc_id", "left_semi").withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(_learn(rounds, buckets), "bucket long, weight double")
    found = learned.orderBy("bucket").collect()
    at, weights = np.array([r["bucket"] for r in found], np.int64), np.array([r["weight"] for r in found])
    inner = at < buckets
    return at[inner], weights[inner], float(weights[~inner].sum())


def with_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], column: str = "score", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the toxicity score of every text as ``column``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        at, weight, bias = shared.value
        used = np.zeros(buckets, bool)
        used[at] = True
        out = []
        for block in blocks(text):
            row, bucket = block_features(block, buckets)
            hit = np.flatnonzero(used[bucket])
            pair = np.unique(row[hit] * buckets + bucket[hit])
            total = bias + np.bincount(pair // buckets, weight[np.searchsorted(at, pair % buckets)], block.rows)
            out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return pa.array(np.round(np.concatenate(out), 6) if out else np.zeros(0))

    return docs.withColumn(column, scored(F.col("text")))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    out = with_toxicity(docs.select("doc_id", "text"), train(docs, labels, folds=folds, held_out=held_out))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
