"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  The perfect Golay
code (23, 12) puts every segment within three bits of exactly one codeword, named by 12 bits; a
segment's *fuzzy keys* are the codewords that it reaches with at most one bit flipped (1 or 6 of
them).  Two segments at distance one share the codeword that decodes either of them.

Two fingerprints within four bits split their errors over three segments, so by pigeonhole
either some segment is equal, or two segments have exactly one error each.  Keys therefore are
(a) each segment itself and (b) for each pair of segments, the pair of codewords: one side offers
its decoded pair, the other all pairs of its fuzzy keys.  Candidates meet by key and are verified
by counting differing bits.

Only distinct fingerprints take part, so copies cost nothing beyond one aggregation.  Keys are
shuffled by value; a task compares the members of its keys block-wise in arrays, and emits a
spanning forest of the verified links, never the pairs: at most one row per fingerprint and task.
A very common key holds distinct fingerprints only - around one text there are 43,745 within three
bits - and is compared in place.  Components are found by contraction over written edge tables.

Defined results: a text without words (or NULL) has fingerprint zero; fewer words than a shingle
give one shingle of all; NULL ids carry no id into the minimum (a component with only NULL ids has
NULL); repeated rows are rows of one component; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.components import components, spanning_edges
from abtforge.llm.store import written

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# generator polynomial of the binary Golay code (23, 12, 7): fixed value
_GOLAY = 0b110001110101


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bit of the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and blanks 0x20, 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:1 - shingle].tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        part = h[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Column of fingerprints as long (the 64 bits, signed)."""

    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        values = [fingerprint(v.as_buffer().to_pybytes() if v.is_valid else b"", shingle) for v in column.cast(pa.large_binary())]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return run(text)


def _golay_tables() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes by byte of a 23-bit word, and the error pattern of each syndrome."""

    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= _GOLAY << (bit - 11)
        return v

    bits = [remainder(1 << i) for i in range(24)]
    by_byte = []
    for shift in (0, 8, 16):
        table = np.zeros(256, np.int64)
        for value in range(256):
            for i in range(8):
                if value >> i & 1:
                    table[value] ^= bits[shift + i]
        by_byte.append(table)
    errors = np.zeros(2048, np.int64)
    for i in range(23):
        errors[bits[i]] = 1 << i
        for j in range(i):
            errors[bits[i] ^ bits[j]] = 1 << i | 1 << j
            for m in range(j):
                errors[bits[i] ^ bits[j] ^ bits[m]] = 1 << i | 1 << j | 1 << m
    return by_byte, errors


def codeword_index(segment: np.ndarray, tables) -> np.ndarray:
    """The 12 message bits of the codeword nearest to each 23-bit word."""
    by_byte, errors = tables
    syndrome = by_byte[0][segment & 255] ^ by_byte[1][segment >> 8 & 255] ^ by_byte[2][segment >> 16]
    return (segment ^ errors[syndrome]) >> 11


def fuzzy_keys(segment: np.ndarray, bits: int, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(decoded index, all indices within one flipped bit sorted by row, mask of distinct ones)."""
    own = codeword_index(segment, tables)
    flips = [codeword_index(segment ^ (1 << i), tables) for i in range(bits)]
    every = np.sort(np.stack([own, *flips], axis=1), axis=1)
    first = np.ones(every.shape, bool)
    first[:, 1:] = every[:, 1:] != every[:, :-1]
    width = int(first.sum(1).max(initial=1))
    order = np.argsort(~first, axis=1, kind="stable")[:, :width]
    return own, np.take_along_axis(every, order, 1), np.take_along_axis(first, order, 1)


_KEYED = "key long, fp long, offered int"


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each fingerprint: ``offered`` 0 for its own (segment or decoded pair), 1 for fuzzy ones."""
    tables = _golay_tables()
    for batch in batches:
        fp = batch["fp"].to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            wide = part.view(np.uint64)
            segments = [((wide >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
            keys, owner, offered = [], [], []

            def add(kind: int, value: np.ndarray, who: np.ndarray, fuzzy: int) -> None:
                keys.append(kind << 48 | value)
                owner.append(who)
                offered.append(np.full(len(value), fuzzy, np.int32))

            fuzzy = []
            for kind, (segment, (_, bits)) in enumerate(zip(segments, SEGMENTS)):
                add(kind, segment, part, 0)
                fuzzy.append(fuzzy_keys(segment, bits, tables))
            for kind, (x, y) in enumerate(((0, 1), (0, 2), (1, 2)), start=3):
                (own_x, all_x, is_x), (own_y, all_y, is_y) = fuzzy[x], fuzzy[y]
                own = own_x << 12 | own_y
                add(kind, own, part, 0)
                pairs = all_x[:, :, None] << 12 | all_y[:, None, :]
                wanted = is_x[:, :, None] & is_y[:, None, :] & (pairs != own[:, None, None])
                add(kind, pairs[wanted], np.broadcast_to(part[:, None, None], pairs.shape)[wanted], 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owner)),
                                              pa.array(np.concatenate(offered))], ["key", "fp", "offered"])


def _link(max_bits: int, fold_at: int = 1 << 20):
    """mapInArrow body over rows sorted by (key, offered): spanning edges of the verified links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def fold() -> None:
            nonlocal found, size
            if found:
                found = [spanning_edges(*(np.concatenate(x) for x in zip(*found)))]
                size = 0

        def compare(key: np.ndarray, fp: np.ndarray, own: np.ndarray) -> None:
            """Each own member against all later members of its key."""
            nonlocal size
            i = np.flatnonzero(own)
            step = 1
            while len(i):
                i = i[i + step < len(key)]
                i = i[key[i] == key[i + step]]
                near = i[np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64)) <= max_bits]
                if len(near):
                    found.append((fp[near], fp[near + step]))
                    size += len(near)
                    if size > fold_at:
                        fold()
                step += 1

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            key, fp, offered = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "fp", "offered"))
            if not len(key):
                continue
            held.append((key, fp, offered == 0))
            if held[0][0][0] == key[-1]:
                continue  # one key goes on through all that is held
            key, fp, own = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(key, key[-1], "left"))
            compare(key[:cut], fp[:cut], own[:cut])
            held = [(key[cut:], fp[cut:], own[cut:])]
        if held:
            compare(*(np.concatenate(x) for x in zip(*held)))
        fold()
        for u, v in found:
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def fingerprint_roots(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the distinct fingerprints that link to any other."""
    if max_bits > MAX_BITS:
        raise ValueError(f"three Golay segments guarantee links of at most {MAX_BITS} bits")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("fp").repartition(parts, "fp").mapInArrow(_emit_keys, _KEYED)
    edges = keyed.repartition(parts, "key").sortWithinPartitions("key", "offered").mapInArrow(_link(max_bits), "u long, v long")
    return components(edges).select(F.col("node").alias("fp"), "root")


def with_components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Adds ``root`` (one value per group of linked rows) to rows with ``fp``."""
    roots = fingerprint_roots(rows.select("fp").distinct(), max_bits)
    return rows.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``."""
    rows = written(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "simhash")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = with_components(per, max_bits)
    low = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = linked.join(low, "root").select("fp", "component_id")
    return rows.join(answer, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest id, then the smallest text."""
    names = docs.columns
    # two hashes with different orders: rows are told apart by 128 bits and the id
    own = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id", F.lit(1)).alias("b")).alias("_own")
    rows = written(docs.select("doc_id", own, fingerprints(F.col("text"), shingle).alias("fp")), "simhash")
    linked = with_components(rows.select("fp").distinct(), max_bits)
    # copies meet by map-side minima before any join
    per = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_own")).alias("k"))
    first = (per.join(linked, "fp").groupBy("root").agg(F.min("k").alias("k"))
             .select(F.col("k.doc_id").alias("k_id"), F.col("k._own").alias("k_own")))
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), own)
    kept = plain.join(first, (plain["_own"] == first["k_own"]) & plain["_id"].eqNullSafe(first["k_id"]))
    return kept.dropDuplicates(["_id", "_own"]).select(*[F.col("_row").getField(c).alias(c) for c in names])
