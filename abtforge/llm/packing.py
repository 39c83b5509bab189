"""Packing documents into windows of a fixed number of tokens.

A document is its token ids and an end id.  Whole windows are cut off first; the remainders
(1 .. window - 1 tokens) are packed by non-negative least squares: pairs and triples of lengths
that fill a window exactly are enumerated, the repeat counts that best explain the histogram of
remainders are solved with multiplicative updates, rounded within what the histogram holds, and
whatever is left is packed greedily, longest first, cutting a document where a window is full.
The last window of a bucket is cut into powers of two, which need no padding.

The work is one pass over the texts without a shuffle: a task tokenises the rows of its partition
and packs them bucket by bucket (``BUCKET_TOKENS`` tokens), so memory is bounded, no histogram goes
through the driver, and a lost task is simply run again: sequence ids are the partition number and
a running number, and the result depends on the partition's rows alone.

Token ids are those of the given ``tokenizers`` file.  Where the same vocabulary is also given as
ranks (a ``.tiktoken`` file) the ids are computed from those, several times faster and equal, and
texts that hold a special token's string go through ``tokenizers`` itself.

Defined results: NULL and empty texts are one piece with the end id alone; NULL or repeated ids
are packed row by row; a text longer than a bucket is a bucket of its own; columns beside
``doc_id`` and ``text`` are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
END_ID = 1
BUCKET_TOKENS = 8 << 20
TRIPLES = 1 << 13
UPDATES = 40

# pre-tokenisation pattern of the byte-level vocabulary: fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# the same for texts without two blanks in a row: nothing to look ahead for
_PATTERN_SINGLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
_DOUBLE = re.compile(r"\s\s")


class Encoder:
    """Token ids of the tokenizer file ``name`` (see the module's note on ranks)."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(public_tokenizers.path(name))
        self._special = [t.content for t in self._exact.get_added_tokens_decoder().values() if t.special]
        self._fast = None
        try:
            ranks_path = public_tokenizers.path(name.replace(".json", ".tiktoken"))
            lines = open(ranks_path, "rb").read().splitlines()
        except (OSError, KeyError, ValueError):
            return
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        self._fast = [tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (_PATTERN_SINGLE, PATTERN)]

    def ids(self, text: str) -> np.ndarray:
        if self._fast is None or any(s in text for s in self._special):
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast[_DOUBLE.search(text) is not None].encode_ordinary(text), np.uint32)


def window_fillings(present: np.ndarray, window: int, triples: int = TRIPLES) -> np.ndarray:
    """(m x 3) lengths that sum to ``window``, from the sorted lengths ``present``; 0 for no third."""
    there = np.zeros(window + 1, bool)
    there[present] = True
    low = present[present * 2 <= window]
    pairs = low[there[window - low]]
    out = [np.stack([pairs, window - pairs, np.zeros_like(pairs)], 1)]
    # triples a <= b <= c, spread evenly over a when there are more than wanted
    a = present[present * 3 <= window]
    if len(a) and triples:
        per = max(1, triples // len(a))
        for x in a.tolist():
            b = present[(present >= x) & (2 * present <= window - x)]
            b = b[there[window - x - b]]
            b = b[np.linspace(0, len(b) - 1, min(per, len(b))).astype(int)] if len(b) else b
            out.append(np.stack([np.full_like(b, x), b, window - x - b], 1))
    return np.concatenate(out)


def solve_counts(histogram: np.ndarray, fillings: np.ndarray, updates: int = UPDATES) -> np.ndarray:
    """Non-negative repeat counts x with A x near the histogram (A: lengths used by each filling).

    Multiplicative updates x <- x * (A'h) / (A'A x) keep x non-negative and never raise the error."""
    n = len(histogram)
    used = fillings.copy()
    third = used[:, 2] > 0
    weight = third.astype(float)

    def back(v: np.ndarray) -> np.ndarray:
        return v[used[:, 0]] + v[used[:, 1]] + weight * v[used[:, 2]]

    goal = back(histogram.astype(float))
    x = goal / 3 / max(1.0, len(fillings) / max(1, n))
    for _ in range(updates):
        made = (np.bincount(used[:, 0], x, n) + np.bincount(used[:, 1], x, n) + np.bincount(used[:, 2], x * weight, n))
        x = x * goal / np.maximum(back(made), 1e-9)
    return x


def plan_remainders(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of exactly filled windows that the histogram can supply."""
    left = histogram.copy()
    fillings = window_fillings(np.flatnonzero(histogram), window)
    if not len(fillings):
        return []
    x = solve_counts(histogram, fillings)
    plan: dict[tuple[int, ...], int] = {}
    rounded = np.floor(x + 0.5)
    # whole counts first, then single windows by the largest fractions
    for counts in (rounded, np.maximum(1, rounded)):
        for at in np.argsort(-(x if counts is rounded else x - np.floor(x)), kind="stable").tolist():
            want = int(counts[at])
            if not want:
                continue
            lengths = tuple(v for v in fillings[at].tolist() if v)
            need = {v: lengths.count(v) for v in lengths}
            take = min(want, *(int(left[v]) // k for v, k in need.items()))
            if take:
                for v, k in need.items():
                    left[v] -= k * take
                plan[lengths] = plan.get(lengths, 0) + take
    return list(plan.items())


def pack_bucket(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece, for documents of these lengths."""
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for doc in np.flatnonzero(lengths >= window).tolist():
        for start in range(0, int(lengths[doc]) // window * window, window):
            out.append((doc, start, window, sequence, 0))
            sequence += 1
    rest = lengths % window
    histogram = np.bincount(rest, minlength=window + 1)
    histogram[0] = 0
    waiting: dict[int, list[int]] = {}
    for doc in np.flatnonzero(rest)[::-1].tolist():
        waiting.setdefault(int(rest[doc]), []).append(doc)
    for combination, repeats in plan_remainders(histogram, window):
        for _ in range(repeats):
            offset = 0
            for size in combination:
                doc = waiting[size].pop()
                out.append((doc, int(lengths[doc]) - size, size, sequence, offset))
                offset += size
            sequence += 1
    # what is left: longest first into one stream, cut where a window ends
    stream = [(doc, int(lengths[doc]) - size, size) for size in sorted(waiting, reverse=True) for doc in reversed(waiting[size])]
    total = sum(size for _, _, size in stream)
    room = iter([window] * (total // window) + [1 << bit for bit in range(window.bit_length(), -1, -1) if (total % window) >> bit & 1])
    space, size_now = 0, 0
    for doc, start, size in stream:
        while size:
            if not space:
                space = size_now = next(room)
                sequence += 1
            take = min(space, size)
            out.append((doc, start, take, sequence - 1, size_now - space))
            start, size, space = start + take, size - take, space - take
    return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", window: int = WINDOW, end_id: int = END_ID,
         bucket_tokens: int = BUCKET_TOKENS, with_ids: bool = True) -> DataFrame:
    """Pieces of the packed corpus; ``ids`` (unsigned 32-bit little-endian) on request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        base = TaskContext.get().partitionId() << 36
        held: list[tuple[int | None, np.ndarray]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, base
            pieces = pack_bucket(np.array([len(ids) for _, ids in held], np.int64), window)
            cuts = [held[doc][1][start:start + size] for doc, start, size, _, _ in pieces]
            columns = [pa.array([held[p[0]][0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()),
                       pa.array([p[2] for p in pieces], pa.int64()), pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                       pa.array([len(held[p[0]][1]) for p in pieces], pa.int64()), pa.array([base + p[3] for p in pieces], pa.int64()),
                       pa.array([p[4] for p in pieces], pa.int64())]
            names = [f.split()[0] for f in _PIECES.split(", ")]
            if with_ids:
                columns, names = [*columns, pa.array([c.tobytes() for c in cuts], pa.binary())], [*names, "ids"]
            base += max(p[3] for p in pieces) + 1
            held, tokens = [], 0
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                if held and tokens + len(ids) > bucket_tokens:
                    yield flush()
                held.append((doc.as_py(), ids))
                tokens += len(ids)
        if held:
            yield flush()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, _PIECES + (", ids binary" if with_ids else ""))
