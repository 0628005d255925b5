"""Fixed-size summaries of 64-bit hashes, gathered by a packed shuffle.

Each task sorts and thins its own hashes (a hot value becomes one entry a task) and ships them as packed
blocks by hash range; a reducer sees each value once a task at most, and returns the slice of a fixed-size
array that belongs to its range.  The driver gets ``2**bits`` bits (or bytes) in all, whatever the input.
When the input is too large for the array, it marks everything: nothing is ever lost, later joins carry more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import data_width, estimated_bytes

BLOCK_SCHEMA = "bucket long, block binary"
#: log2 of the number of bits of the repeat filter (16 MB).
REPEAT_BITS = 27
#: log2 of the number of one-byte cells of the frequency sketch (8 MB).
COUNT_BITS = 23


def bucket_bits(df: DataFrame, per_bucket: int = 4 << 20, most: int = 20) -> int:
    """Buckets follow the input's size, so a reducer's share stays about the same."""
    return min(most, max(6, (estimated_bytes(df) // per_bucket).bit_length()))


def _blocks(values: np.ndarray, extra: np.ndarray | None, bits: int) -> Iterator[tuple[int, bytes]]:
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cuts.tolist(), len(values)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            v = values[lo:hi]
            # 48 bits are kept: a chance clash marks a value without need and loses nothing
            block = (v >> np.uint64(32)).astype(np.uint32).tobytes() + ((v >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()
            yield int(bucket[lo]), block if extra is None else block + extra[lo:hi].tobytes()


def _unblock(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(block) // (6 + width)
    high = np.frombuffer(block, np.uint32, n).astype(np.uint64) << np.uint64(32)
    low = np.frombuffer(block, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(16)
    return high | low, np.frombuffer(block, np.uint8 if width == 1 else np.uint32, n, 6 * n)


def _gather(df: DataFrame, columns: list[str], emit: Callable, reduce: Callable, bits: int) -> dict[int, bytes]:
    def mapped(batches):
        for out in emit(batches):
            bucket, block = zip(*out, strict=True) if out else ((), ())
            if bucket:
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(block, pa.binary())], names=["bucket", "block"])

    def reduced(batches):
        # the rows come sorted by bucket, so one bucket at a time is held
        key, held = None, []

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([reduce(key, held)], pa.binary())], names=["bucket", "block"])

        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != key and held:
                    yield done()
                    held = []
                key = k
                held.append(b.as_py())
        if held:
            yield done()

    rows = (
        df.select(*columns).mapInArrow(mapped, BLOCK_SCHEMA)
        .repartition(data_width(df), "bucket").sortWithinPartitions("bucket").mapInArrow(reduced, BLOCK_SCHEMA).toArrow()
    )
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True))


def repeat_filter(df: DataFrame, columns: list[str], hashes: Callable) -> np.ndarray:
    """Bit array (as bytes) of the values that occur in two or more documents.

    ``hashes(batch)`` yields (values, document ordinals): arrays of one chunk, in which documents are numbered.
    A clear bit proves that a value occurs in one document only.
    """
    bits = bucket_bits(df)
    span = REPEAT_BITS - bits

    def emit(batches):
        held, n = [], 0
        for batch in batches:
            for values, doc in hashes(batch):
                order = np.argsort(values, kind="stable")
                v, d = values[order], doc[order]
                new = np.ones(len(v), bool)
                new[1:] = v[1:] != v[:-1]
                at = np.flatnonzero(new)
                many = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at) if len(at) else np.zeros(0, bool)
                held.append((v[at], many))
                n += len(at)
                if n > 2_000_000:
                    yield list(merged(held))
                    held, n = [], 0
        if held:
            yield list(merged(held))

    def merged(held):
        v, many = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        order = np.argsort(v, kind="stable")
        v, many = v[order], many[order]
        new = np.ones(len(v), bool)
        new[1:] = v[1:] != v[:-1]
        at = np.flatnonzero(new)
        if not len(at):
            return
        # a value of two chunks is one of two documents
        times = np.diff(np.append(at, len(v)))
        flag = (np.logical_or.reduceat(many, at) | (times > 1)).astype(np.uint8)
        yield from _blocks(v[at], flag, bits)

    def reduce(k, blocks):
        parts = [_unblock(b, 1) for b in blocks]
        v, many = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(bool)
        order = np.argsort(v)
        v, many = v[order], many[order]
        same = v[1:] == v[:-1]
        many[1:] |= same
        local = ((v[many] >> np.uint64(64 - REPEAT_BITS)) & np.uint64((1 << span) - 1)).astype(np.int64)
        out = np.zeros(1 << span, bool)
        out[local] = True
        return np.packbits(out).tobytes()

    found = _gather(df, columns, emit, reduce, bits)
    full = np.zeros(1 << (REPEAT_BITS - 3), np.uint8)
    size = (1 << span) // 8
    for k, block in found.items():
        full[k * size : (k + 1) * size] = np.frombuffer(block, np.uint8)
    return full


def marked(filter_bytes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values the repeat filter marks."""
    at = (values >> np.uint64(64 - REPEAT_BITS)).astype(np.int64)
    return (filter_bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def count_sketch(df: DataFrame, columns: list[str], hashes: Callable) -> np.ndarray:
    """One byte a cell: 1 for a cell with a single occurrence, else about 8 * log2 of its count (2 to 255).

    Counts are never too small, and equal values have equal cells.
    """
    bits = bucket_bits(df)
    span = COUNT_BITS - bits

    def emit(batches):
        held, n = [], 0
        for batch in batches:
            for values in hashes(batch):
                held.append(values)
                n += len(values)
                if n > 2_000_000:
                    yield list(merged(held))
                    held, n = [], 0
        if held:
            yield list(merged(held))

    def merged(held):
        v, c = np.unique(np.concatenate(held), return_counts=True)
        yield from _blocks(v, np.minimum(c, 0xFFFFFFFF).astype(np.uint32), bits)

    def reduce(k, blocks):
        total = np.zeros(1 << span, np.float64)
        for b in blocks:
            v, c = _unblock(b, 4)
            local = ((v >> np.uint64(64 - COUNT_BITS)) & np.uint64((1 << span) - 1)).astype(np.int64)
            total += np.bincount(local, c, 1 << span)
        cell = np.where(total <= 1, total, np.clip(np.ceil(8 * np.log2(np.maximum(total, 1))), 2, 255))
        return cell.astype(np.uint8).tobytes()

    found = _gather(df, columns, emit, reduce, bits)
    full = np.zeros(1 << COUNT_BITS, np.uint8)
    for k, block in found.items():
        full[k << span : (k + 1) << span] = np.frombuffer(block, np.uint8)
    return full


def cell_of(sketch: np.ndarray, values: np.ndarray) -> np.ndarray:
    return sketch[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
