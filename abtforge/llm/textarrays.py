"""Vectorised views of Arrow text columns for code that runs inside tasks.

A text column becomes one byte array plus row offsets; words, word hashes and substring hashes
are then array operations over all rows of a block.  Blocks are cut by bytes, so the working
memory does not depend on how many rows Arrow delivers at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ALNUM = np.zeros(256, bool)
ALNUM[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


class Block(NamedTuple):
    """Rows ``first .. first + rows`` of a column: their bytes and row offsets (rows + 1)."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK_BYTES, most: int = BLOCK_ROWS) -> Iterator[Block]:
    """Cut a text column into runs of at most ``most`` whole rows and about ``limit`` bytes (a longer
    row is a block of its own); NULL counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1 + column.offset)[column.offset:] if n else np.zeros(1, np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + most)
        yield Block(lo, hi - lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every maximal run of bytes with ``inside[byte]``; rows never join."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    flag = inside[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = flag[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = flag[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    after[tails] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Row of every byte of a block."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, 1 << 16)
        step = np.full(size, _BASE if kind == "base" else _INVERSE, np.uint64)
        step[0] = 1
        have = _powers[kind] = np.multiply.accumulate(step)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums modulo 2^64 (length n + 1); see ``span_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end): equal bytes give equal hashes wherever they stand."""
    return mix((prefix[ends] - prefix[starts]) * _power("inverse", len(prefix))[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all its bits (a fixed bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    return h * np.uint64(0xD6E8FEB86659FD93)
