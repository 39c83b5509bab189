"""Removal of repeated passages with a hash-compared suffix sort.

A byte is removed when a string of ``length`` bytes that covers it also starts anywhere else in
the corpus.  Sorting every suffix of a corpus would shuffle every byte many times over, so the
sort is split by content first:

1. *Anchors.*  In every ``length``-byte window the ``GRAM``-byte string with the smallest hash is
   the window's anchor.  Equal windows have equal anchors at equal places, so windows can only
   repeat inside a group of equal anchors; a text has about one anchor per 80 bytes.  All windows
   of one anchor are one *block* of text.  Anchors are found with prefix polynomial hashes and a
   sliding minimum, block-wise over arrays.
2. Groups whose anchor occurs once are done.  Blocks that are equal as a whole (in the anchor's hash
   and a 128-bit digest of the block and the anchor's place in it, which stands for the comparison of the
   bytes) repeat as a whole: sums with map-side combining, so copies and very common passages cost one
   row per task.
3. The remaining distinct blocks of each group are suffix-sorted: a bottom-up mergesort orders
   them by the text from the anchor on, and once more by the text before it read backwards.  Two
   suffixes are compared by finding their common extension with a binary search over prefix
   hashes, so a comparison is logarithmic in the text; all comparisons of a merge level are one
   array operation.  Neighbours give the longest extensions on either side and thereby the
   repeated windows.  Extensions that decide a removal are verified byte by byte.  Windows that
   no neighbour settles are compared by their own hash within the group.
4. Groups of more than ``GROUP_LIMIT`` distinct blocks never go to one task: their windows are
   counted one by one over the cluster (by two independent 64-bit hashes), with the same result.

Repeated windows go back to the rows as byte spans, joined on a 64-bit key of id and text; keys that rows
of different content share are found first and those rows get another hash, until none are shared.
A table is deleted when its successors are written.

Defined results: NULL text is empty; texts shorter than ``length`` lose nothing, and neither does
text that occurs once; a row that is repeated as a whole counts as often as it occurs; strings are
judged on the input; very long texts are cut into overlapping pieces, no window is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.store import spent, written
from abtforge.llm.textarrays import blocks, prefix_hash, span_hash

LENGTH = 200
GRAM = 40
GROUP_LIMIT = 50_000
_PLACE_BITS = 24  # of a position inside a piece, beside the hash that ranks anchors
_PIECE = 1 << 22


def row_key(shared: tuple[list[int], ...] = (), bits: int = 64) -> Column:
    """Key of a row by id and text.  ``shared`` lists, seed by seed, the keys to be hashed anew."""
    hashed = lambda seed: F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 64 - bits) if bits < 64 else F.xxhash64("doc_id", "text", F.lit(seed))
    key = hashed(0)
    for seed, keys in enumerate(shared, 1):
        key = F.when(key.isin(keys), hashed(seed)).otherwise(key)
    return key


def exact_key(docs: DataFrame, bits: int = 64) -> Column:
    """A ``row_key`` that no two rows of different id or text share.

    A second hash tells rows of one key apart: one narrow aggregate per seed, nearly always one in all.
    About rows^2 / 2^65 keys come to the driver.
    """
    shared: tuple[list[int], ...] = ()
    for _ in range(64):
        key = row_key(shared, bits)
        other = F.xxhash64("text", "doc_id", F.lit("other"))
        each = docs.select(key.alias("key"), other.alias("other")).groupBy("key").agg(F.min("other").alias("least"), F.max("other").alias("most"))
        found = [r["key"] for r in each.where("least <> most").select("key").collect()]
        if not found:
            return key
        shared += (found,)
    raise ValueError("no key without collisions found")


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows' bytes, offsets, start in the text); a long text in pieces that share length - 1 bytes."""
    if len(data) <= _PIECE + length:
        yield 0, data, offsets, np.zeros(len(offsets) - 1, np.int64)
        return
    for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
        for at in range(0, max(1, int(b - a) - length + 1), _PIECE):
            part = data[a + at:min(b, a + at + _PIECE + length - 1)]
            yield row, part, np.array([0, len(part)]), np.array([at])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i with a full window."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Anchor hash, anchor place, first and last window start, and row of every block."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 4
    prefix = prefix_hash(data)
    at = np.arange(n - gram + 1)
    hashes = span_hash(prefix, at, at + gram)
    # rank by hash, leftmost first among equals: depends on the window's text alone
    ranked = (hashes & ~np.uint64((1 << _PLACE_BITS) - 1)) | at.astype(np.uint64)
    lowest = (_sliding_min(ranked, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n - length + 1]
    inside = np.arange(n - length + 1) + length <= offsets[1:][row]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 4
    anchor = lowest[starts]
    change = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[starts][1:] != row[starts][:-1])])
    last = starts[np.r_[change[1:], len(starts)] - 1]
    return hashes[anchor[change]], anchor[change], starts[change], last, row[starts[change]]


_ANCHORS = "h long, full long, full2 long, key long, at long, before int, windows int"


def _emit_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False)
            for block in blocks(batch["text"]):
                for first, data, offsets, start in _pieces(block.data, block.offsets, length):
                    h, anchor, lo, hi, row = find_anchors(data, offsets, length, gram)
                    if not len(h):
                        continue
                    raw = data.tobytes()
                    before = (anchor - lo).tolist()
                    full = np.frombuffer(b"".join([digest(raw[a:b], s) for a, b, s in zip(lo.tolist(), (hi + length).tolist(), before)]), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(full[:, 0]), pa.array(full[:, 1]), pa.array(keys[block.first + first + row]),
                         pa.array(anchor - offsets[row] + start[row]), pa.array((anchor - lo).astype(np.int32)),
                         pa.array((hi - lo + 1).astype(np.int32))], ["h", "full", "full2", "key", "at", "before", "windows"])

    return run


class Suffixes:
    """Blocks of anchor groups in one byte buffer, compared by hash around their anchors."""

    def __init__(self, texts: list[bytes], before: np.ndarray, group: np.ndarray):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        self.start = np.r_[0, ends[:-1]].astype(np.int64)
        self.anchor = self.start + before
        self.before = before.astype(np.int64)
        self.after = ends - self.anchor
        self.group = group
        self.prefix = prefix_hash(self.data)

    def _equal(self, i, j, lo, hi) -> np.ndarray:
        """Whether bytes [anchor + lo, anchor + hi) agree, by hash."""
        return span_hash(self.prefix, self.anchor[i] + lo, self.anchor[i] + hi) == span_hash(self.prefix, self.anchor[j] + lo, self.anchor[j] + hi)

    def extension(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Common bytes after (or before) the anchors of i and j: binary search over prefix hashes."""
        side = self.after if forward else self.before
        low, high = np.zeros(len(i), np.int64), np.minimum(side[i], side[j])
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self._equal(i, j, 0, mid) if forward else self._equal(i, j, -mid, 0)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        side = self.after if forward else self.before
        common = self.extension(i, j, forward)
        ended = common >= np.minimum(side[i], side[j])
        step = np.where(ended, 0, common) if forward else np.where(ended, -1, -common - 1)
        edge = len(self.data) - 1
        one, other = (self.data[np.clip(self.anchor[x] + step, 0, edge)] for x in (i, j))
        return np.where(ended, side[i] < side[j], one < other)

    def sort(self, forward: bool) -> np.ndarray:
        """Order of all blocks by (group, suffix): bottom-up mergesort, one array step per level.

        Every element finds its place in the run that its own run merges with, by binary search."""
        order = np.argsort(self.group, kind="stable")
        sizes = np.bincount(self.group)
        offset = np.repeat(np.cumsum(sizes) - sizes, sizes)  # of the group, by position
        total = np.repeat(sizes, sizes)
        rank = np.arange(len(order)) - offset
        run = 1
        while run < sizes.max(initial=0):
            left = (rank // run) % 2 == 0
            base = rank // (2 * run) * (2 * run)
            other = np.where(left, base + run, base)
            size = np.clip(total - other, 0, run)
            moving = np.flatnonzero(np.where(left, size > 0, True) & (total > run))
            item = order[moving]
            low, high = np.zeros(len(moving), np.int64), size[moving].copy()
            first, from_left = offset[moving] + other[moving], left[moving]
            while (low < high).any():
                open_ = np.flatnonzero(low < high)
                mid = (low[open_] + high[open_]) // 2
                rival = order[first[open_] + mid]
                # a left element passes strictly smaller rivals, a right one also equal ones
                passes = np.where(from_left[open_], self.less(rival, item[open_], forward), ~self.less(item[open_], rival, forward))
                low[open_] = np.where(passes, mid + 1, low[open_])
                high[open_] = np.where(passes, high[open_], mid)
            own = rank[moving] - base[moving] - np.where(from_left, 0, run)
            merged = order.copy()
            merged[offset[moving] + base[moving] + own + low] = item
            order = merged
            run *= 2
        return order

    def verified(self, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether [anchor - left, anchor + right) is the same bytes in i and j."""
        size = left + right
        out = np.ones(len(i), bool)
        for a in range(0, len(i), 1 << 14):
            part = slice(a, a + (1 << 14))
            where = np.repeat(np.arange(len(size[part])), size[part])
            step = np.arange(len(where)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            x = (self.anchor[i[part]] - left[part])[where] + step
            y = (self.anchor[j[part]] - left[part])[where] + step
            bad = where[self.data[x] != self.data[y]]
            out[part][np.unique(bad)] = False
        return out


def repeated_offsets(texts: list[bytes], before: np.ndarray, windows: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """(blocks x length) flags: the window that starts d bytes before the anchor stands in another block of the group."""
    s = Suffixes(texts, before, group)
    n = len(texts)
    reach = length  # windows start at most length - gram bytes before the anchor
    marks = np.zeros((n, reach + 1), np.int16)
    best = {}
    for forward in (True, False):
        order = s.sort(forward)
        pair = np.flatnonzero(group[order[1:]] == group[order[:-1]])
        i, j = order[pair], order[pair + 1]
        right, left = s.extension(i, j, True), s.extension(i, j, False)
        good = right + left >= length
        bad = good.copy()
        bad[good] = ~s.verified(i[good], j[good], left[good], right[good])
        for at in np.flatnonzero(bad):  # a hash collision: the true extensions, byte by byte
            a, b = i[at], j[at]
            x, y = s.data[s.anchor[a]:s.anchor[a] + right[at]], s.data[s.anchor[b]:s.anchor[b] + right[at]]
            right[at] = int(np.argmax(np.r_[x != y, True]))
            x, y = s.data[s.anchor[a] - left[at]:s.anchor[a]][::-1], s.data[s.anchor[b] - left[at]:s.anchor[b]][::-1]
            left[at] = int(np.argmax(np.r_[x != y, True]))
        low, high = np.maximum(length - right, 0), left
        use = low <= high
        for x in (i, j):
            np.add.at(marks, (x[use], low[use]), 1)
            np.add.at(marks, (x[use], high[use] + 1), -1)
        most = np.zeros(n, np.int64)
        for x in (i, j):
            np.maximum.at(most, x, right if forward else left)
        best[forward] = most
    flags = np.cumsum(marks, axis=1)[:, :reach] > 0
    d = np.arange(reach)
    own = (d[None, :] <= before[:, None]) & (d[None, :] > (before - windows)[:, None])
    possible = own & (d[None, :] <= best[False][:, None]) & (length - d[None, :] <= best[True][:, None]) & ~flags
    for at in np.flatnonzero(possible.any(0)):  # neighbours on the two sides differ: the window itself decides
        busy = np.zeros(int(group.max()) + 1, bool)
        busy[group[possible[:, at]]] = True
        who = np.flatnonzero(busy[group] & own[:, at])
        begin = s.anchor[who] - at
        window = span_hash(s.prefix, begin, begin + length)
        exact = [texts[x][int(b - s.start[x]):int(b - s.start[x]) + length] for x, b in zip(who, begin)]
        seen: dict[tuple, int] = {}
        for x, g, h, text in zip(who.tolist(), group[who].tolist(), window.tolist(), exact):
            first = seen.setdefault((g, h, text), x)
            if first != x:
                flags[x, at] = flags[first, at] = True
    return flags & own


def _spans_of(flags: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, from, to) byte spans of the runs of flagged windows; ``at`` is the anchor's place."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return row, at[row] - (end - 1), at[row] - first + length


_SPANS = "key long, b long, e long"


def _sort_groups(length: int, task_blocks: int = 1 << 14):
    """mapInArrow body over rows sorted by h: spans of the blocks that occur once (n = 1)."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        h = np.array([r[0] for r in rows])
        group = np.cumsum(np.r_[0, h[1:] != h[:-1]])
        before = np.array([r[4] for r in rows], np.int64)
        windows = np.array([r[5] for r in rows], np.int64)
        flags = repeated_offsets([r[6] for r in rows], before, windows, group, length)
        flags[np.array([r[1] for r in rows]) > 1] = False  # whole blocks that repeat are counted already
        row, begin, end = _spans_of(flags, np.array([r[3] for r in rows], np.int64), length)
        key = np.array([r[2] for r in rows], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(begin), pa.array(end)], ["key", "b", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch[c].to_pylist() for c in ("h", "n", "key", "at", "before", "windows", "block")))
            if len(held) >= task_blocks:
                cut = len(held)
                while cut and held[cut - 1][0] == held[-1][0]:
                    cut -= 1
                if cut:
                    yield from solve(held[:cut])
                    held = held[cut:]
        if held:
            yield from solve(held)

    return run


def _cut_blocks(length: int):
    """mapInArrow body: the text of each listed block of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted, key in zip(batch["text"].cast(pa.large_binary()), batch["wanted"], batch["key"].to_pylist()):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                items = wanted.as_py()
                out = [raw[x["at"] - x["before"]:x["at"] - x["before"] + x["windows"] - 1 + length].tobytes() for x in items]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["h"] for x in items], pa.int64()), pa.array([x["n"] for x in items], pa.int64()), pa.array([key] * len(items), pa.int64()),
                     pa.array([x["at"] for x in items], pa.int64()), pa.array([x["before"] for x in items], pa.int32()),
                     pa.array([x["windows"] for x in items], pa.int32()), pa.array(out, pa.binary())],
                    ["h", "n", "key", "at", "before", "windows", "block"])

    return run


def _one_by_one(length: int):
    """mapInArrow body: every window of each block, for groups too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("h", "n", "key", "at", "before", "windows", "block")]
            for h, n, key, at, before, windows, block in zip(*columns):
                d = np.arange(windows)
                low = [xxhash.xxh3_64_intdigest(block[k:k + length]) for k in range(windows)]
                high = [xxhash.xxh64_intdigest(block[k:k + length], 1) for k in range(windows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(windows, h)), pa.array(before - d), pa.array(np.array(low, np.uint64).view(np.int64)),
                     pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(np.full(windows, n)), pa.array(np.full(windows, key)),
                     pa.array(at - before + d)], ["h", "d", "x", "y", "n", "key", "b"])

    return run


def repeated_spans(docs: DataFrame, key: Column, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """key, spans (distinct (b, e) byte spans, may overlap) of every row with a repeated window."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(key.alias("key"), "text")
    anchors = written(keyed.mapInArrow(_emit_anchors(length, gram), _ANCHORS), "anchors")
    # written, so that the join has a plain side and AQE can split an anchor that very many rows hold
    repeated = written(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "anchors-repeated")
    shared = written(anchors.join(repeated, "h"), "anchors-shared")
    spent(anchors, repeated)
    full = shared.groupBy("h", "full", "full2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at", "before", "windows")).alias("one"))
    full = written(full, "anchors-blocks")
    # blocks that repeat as a whole
    twice = full.where("n > 1").select("h", "full", "full2")
    whole = shared.join(twice, ["h", "full", "full2"]).select("key", (F.col("at") - F.col("before")).alias("b"),
                                                     (F.col("at") - F.col("before") + F.col("windows") - 1 + length).alias("e"))
    # groups with different blocks: their distinct blocks, with text
    kinds = written(full.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "anchors-kinds")
    wanted = full.join(kinds, "h").select("h", "n", "one.*", "kinds")
    per_row = wanted.groupBy("key").agg(F.collect_list(F.struct("h", "n", "at", "before", "windows")).alias("wanted"))
    block = written(keyed.join(per_row, "key").dropDuplicates(["key"]).mapInArrow(
        _cut_blocks(length), "h long, n long, key long, at long, before int, windows int, block binary"), "blocks")
    large = kinds.where(F.col("kinds") > group_limit).select("h")
    sorted_ = (block.join(large, "h", "left_anti").repartition(parts, "h").sortWithinPartitions("h")
               .mapInArrow(_sort_groups(length), _SPANS))
    window = (block.join(large, "h", "left_semi")
              .mapInArrow(_one_by_one(length), "h long, d long, x long, y long, n long, key long, b long"))
    counted = window.groupBy("h", "d", "x", "y").agg(F.sum("n").alias("c")).where("c > 1").drop("c")
    single = window.where("n = 1").join(counted, ["h", "d", "x", "y"]).select("key", "b", (F.col("b") + length).alias("e"))
    every = whole.unionByName(sorted_).unionByName(single)
    # a set: equal rows share their key, and each span counts once however many copies there are
    return every.groupBy("key").agg(F.collect_set(F.struct("b", "e")).alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted((x["b"], x["e"]) for x in spans or ()):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    at, parts = 0, []
    for b, e in spans:
        parts.append(text[at:b])
        at = e
    return [*parts, text[at:]]


def _with_spans(docs: DataFrame, length: int, gram: int, group_limit: int, bits: int = 64) -> tuple[DataFrame, list[str]]:
    names = docs.columns
    key = exact_key(docs, bits)
    spans = repeated_spans(docs, key, length, gram, group_limit)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"),
                       F.col("text").alias("_text"), key.alias("_key"))
    return rows.join(spans, rows["_key"] == spans["key"], "left").drop("key"), names


def removal_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT, bits: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``."""

    @F.arrow_udf("n_removed long, n_spans long, kept_sha256 string")
    def measure(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(text.cast(pa.large_binary()), spans):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            cuts = _merged(s.as_py())
            digest = hashlib.sha256()
            for part in _kept(raw, cuts):
                digest.update(part)
            out.append({"n_removed": sum(e - b for b, e in cuts), "n_spans": len(cuts), "kept_sha256": digest.hexdigest()})
        return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    rows = docs.select("doc_id", "text")
    joined, _ = _with_spans(rows, length, gram, group_limit, bits)
    out = joined.select(F.col("_id").alias("doc_id"), F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("n_bytes"),
                        measure(F.col("_text"), F.col("spans")).alias("m"))
    return out.select("doc_id", "n_bytes", "m.n_removed", "m.n_spans", "m.kept_sha256")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (a character cut in two goes whole);
    ``n_chars``, where present, is counted anew.  Every row stays."""

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(text.cast(pa.large_binary()), spans):
            if not t.is_valid or not s.is_valid:
                out.append(None)
                continue
            raw = t.as_buffer().to_pybytes()
            out.append("".join(p.decode("utf-8", "ignore") for p in _kept(raw, _merged(s.as_py()))))
        return pa.array(out, pa.string())

    joined, names = _with_spans(docs, length, gram, group_limit)
    text = F.when(F.col("spans").isNull(), F.col("_text")).otherwise(cut(F.col("_text"), F.col("spans")))
    joined = joined.withColumn("_new", text)
    fields = []
    for c in names:
        if c == "text":
            fields.append(F.col("_new").alias("text"))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            fields.append(F.when(F.col("spans").isNull(), F.col("_row").getField(c)).otherwise(F.length("_new").cast(kind)).alias(c))
        else:
            fields.append(F.col("_row").getField(c).alias(c))
    return joined.select(*fields)
