"""Vectorised scanning of UTF-8 text columns: words, Rabin-Karp prefix hashes, sliding minima.

All functions work on whole texts.  Polynomial hashes are taken modulo 2**64 from prefix sums, so the hash of
any slice costs two look-ups; a finaliser mixes the bits afterwards.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_WORDS = np.uint64(0xD6E8FEB86659FD93)
#: A second pair of bases: with both, a hash has 128 bits.
SECOND, SECOND_WORDS = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def process_cache() -> dict:
    """A dictionary that lives as long as the Python process, whatever functions come and go in it."""
    name = "scriptoria_process_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__



#: Separators of words: 0x20 and 0x09-0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd, so it has an inverse)."""
    cache = process_cache()
    have = cache.get(("powers", int(base)))
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            made = []
            for b in (base, inverse):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                made.append(np.multiply.accumulate(p))
        have = cache["powers", int(base)] = (made[0], made[1])
    return have[0][:n], have[1][:n]


def prefix_hash(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """P with P[i] = sum of values[j] * base**j for j < i, modulo 2**64."""
    up, _ = powers(base, len(values) + 1)
    p = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=p[1:])
    return p


def slice_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Mixed hashes of the slices [start, end), the same wherever a slice stands."""
    _, down = powers(base, len(p))
    h = (p[end] - p[start]) * down[start]
    h += (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(h)


def text_chunks(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    # the column's own buffers, without a copy
    _, off, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offs = np.frombuffer(off, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and for each document the number of words before it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    p = prefix_hash(data.astype(np.uint64) + np.uint64(1), base)
    return slice_hash(p, starts, ends, base)


def gram_hashes(hashes: np.ndarray, k: int, base: np.uint64 = BASE_WORDS) -> np.ndarray:
    """Rabin-Karp hash of each k consecutive hashes (len - k + 1 of them; none if shorter)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = prefix_hash(hashes, base)
    at = np.arange(n)
    return slice_hash(p, at, at + k, base)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    have, m = 1, values
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:-step], m[step:]) if len(m) > step else m[:0]
        have += step
    return m
