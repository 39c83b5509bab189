"""Quality classifier: nearest neighbours in a latent-semantic space vote by similarity.

A text becomes counts of hashed words and of style terms (pairs of character classes, word
lengths, repeated words); square roots of relative counts, weighted by inverse document frequency,
are projected on the leading right singular vectors of a bounded labelled sample.  The sample's
vectors (``sample`` x ``rank`` floats, at most) are broadcast; every document's cosine with all of
them is computed exactly, block by block, and the ``neighbours`` nearest vote with the power
``sharpness`` of their similarity.

Fitting reads labels of the training folds only; scoring reads the text only and is one pass
without a shuffle, in blocks whose memory does not depend on the table.

Defined results: NULL and empty texts have no direction and get the sample's mean label; so does
every text when nothing is labelled (then 0.5); NULL ids are scored, and are not held out;
repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtforge.llm.samples import fold, labelled_sample
from abtforge.llm.textarrays import SPACE, Block, blocks, prefix_hash, rows_of, span_hash, words

SAMPLE = 4096
RANK = 32
NEIGHBOURS = 15
SHARPNESS = 8
FOLDS = 5
THRESHOLD = 0.3
_WORDS, _CLASSES, _LENGTHS = 512, 16, 32
TERMS = _WORDS + _CLASSES * _CLASSES + 2 + _LENGTHS

# character classes: other ASCII, lower, upper, digit, beyond ASCII, blank, line feed, then single marks
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[32], _CLASS[10] = 5, 6
for _at, _mark in enumerate(b".,!|*$%#&"):
    _CLASS[_mark] = 7 + _at


def term_counts(block: Block) -> np.ndarray:
    """(rows x TERMS) counts of a block of texts."""
    n, data = block.rows, block.data
    out = np.zeros((n, TERMS), np.float32)
    start, end, row = words(data, block.offsets, ~SPACE)
    if not len(start):
        return out
    count = lambda r, kind, kinds: np.bincount(r * kinds + kind, minlength=n * kinds).reshape(n, kinds)
    hashed = span_hash(prefix_hash(data), start, end)
    out[:, :_WORDS] = count(row, (hashed % np.uint64(_WORDS)).astype(np.int64), _WORDS)
    kind, of = _CLASS[data], rows_of(block.offsets)
    inside = of[1:] == of[:-1]
    at = _WORDS + _CLASSES * _CLASSES
    out[:, _WORDS:at] = count(of[:-1][inside], (kind[:-1] * _CLASSES + kind[1:])[inside], _CLASSES * _CLASSES)
    next_same = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    out[:, at] = np.bincount(row[1:][next_same], minlength=n)
    order = np.lexsort((hashed, row))
    again = (hashed[order][1:] == hashed[order][:-1]) & (row[order][1:] == row[order][:-1])
    out[:, at + 1] = np.bincount(row[order][1:][again], minlength=n)
    out[:, at + 2:] = count(row, np.minimum(end - start, _LENGTHS - 1), _LENGTHS)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class LatentVotes(NamedTuple):
    """A fitted model; everything in it is bounded by the sample size and the rank."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @staticmethod
    def fit(counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> LatentVotes:
        if not len(labels):
            return LatentVotes(np.ones(TERMS, np.float32), np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), labels, 0.5)
        idf = (np.log((len(labels) + 1) / ((counts > 0).sum(0) + 1)) + 1).astype(np.float32)
        flat = LatentVotes(idf, np.zeros((TERMS, 0)), counts, labels, 0.0).weighted(counts)
        _, axes = np.linalg.eigh(flat.T.astype(np.float64) @ flat)  # right singular vectors, ascending
        axes = axes[:, ::-1][:, :rank].astype(np.float32)
        return LatentVotes(idf, axes, _unit(flat @ axes), labels.astype(np.float32), float(labels.mean()))

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)) * self.idf)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
        """Similarity-weighted mean label of the nearest sample vectors, 0 to 1."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = _unit(self.weighted(counts) @ self.axes) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** sharpness
        total = weight.sum(1)
        votes = (weight * self.labels[near]).sum(1)
        return np.clip(np.where(total > 0, votes / np.maximum(total, 1e-30), self.prior), 0, 1)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK, folds: int = FOLDS) -> LatentVotes:
    """Fit on at most ``sample`` rows labelled outside the held-out fold (remainder 0)."""
    chosen = labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), folds) == 0, sample)

    @F.arrow_udf("binary")
    def counted(text: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for block in blocks(text) for row in term_counts(block)], pa.binary())

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "y", counted(F.col("text")).alias("terms"))
            .groupBy("doc_id").agg(F.max("y").alias("y"), F.max("terms").alias("terms")).orderBy("doc_id").collect())
    counts = np.stack([np.frombuffer(r["terms"], np.float32) for r in rows]) if rows else np.zeros((0, TERMS), np.float32)
    return LatentVotes.fit(counts, np.array([r["y"] for r in rows], np.float32), rank)


def with_quality(docs: DataFrame, model: LatentVotes, column: str = "score") -> DataFrame:
    """``docs`` with the quality score of every text as ``column``."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        votes = LatentVotes(*shared.value)
        parts = [votes.score(term_counts(block)) for block in blocks(text)]
        return pa.array(np.round(np.concatenate(parts), 6) if parts else np.zeros(0))

    return docs.withColumn(column, scored(F.col("text")))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    out = with_quality(docs.select("doc_id", "text"), fit_quality(docs, labels, folds=folds))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text")
    kept = with_quality(rows, fit_quality(docs, labels), "_score").where(F.col("_score") >= threshold)
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in names])
