"""Best-fit packing of token sequences with swap-based local search.

Only the number of pieces of each length matters to a packing, so it is planned on that histogram (one entry a
length, at most ``capacity`` of them): best-fit decreasing over groups of like bins, then a local search that moves
a document, exchanges one for one or two for one between underfull bins whenever the sum of squared fills grows,
until bins run empty, no exchange is left, or the least possible number of bins is reached.  The plan is a bounded list of bin patterns with multiplicities.  Pieces then find their place by
their rank within their length, which is counted in blocks, so a hot length is never in one task.

Defined results: null text is empty and still has its end id; rows that repeat an id are packed as rows of their
own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table

CAPACITY, END_ID = 2048, 0
#: Pieces of one length that one task ranks.
RANK_BLOCK = 20_000


def byte_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Of a byte-level BPE file of the ``tokenizers`` library: byte strings and their ids, added tokens and their ids."""
    # the public byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}, added


def encoder(path: str) -> tiktoken.Encoding:
    """The same ids as the ``tokenizers`` library gives for the file (a test holds them against it), faster.

    Added tokens inside a text have their own ids, as in that library: encode with ``allowed_special="all"``."""
    ranks, added = byte_vocabulary(path)
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


#: White space of the pattern (Unicode's White_Space) in runs that are too long for a backtracking regular expression.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")


def token_ids(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text of any kind.

    The pattern takes a run of white space as one piece, without its last character if a text goes on behind it.  Long runs are
    taken out here by that rule, as the regular expression would run out of its stack."""
    out: list[int] = []
    at = 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end()
        if end < len(text) and not text.startswith(tuple(enc.special_tokens_set), end):
            end -= 1
        out += enc.encode(text[at : run.start()], allowed_special="all")
        out += enc._encode_single_piece(text[run.start() : end])
        at = end
    return out + enc.encode(text[at:], allowed_special="all")


def cuts(n: int, capacity: int) -> list[int]:
    """Edges of the pieces of a document of n ids: all are full but the first, which may be shorter."""
    head = n % capacity
    return [0, *([head] if head else []), *range(head + capacity, n + 1, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def cut(batches):
        enc = encoder(path)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(token_ids(enc, t.as_py() or ""), np.uint32)
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                edges = cuts(len(ids), capacity)
                for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    doc.append(d)
                    piece.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(ids[lo:hi].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[int, ...]


def best_fit(histogram: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best-fit decreasing over a histogram of lengths: bin patterns and how many bins have each."""
    open_bins: dict[int, Counter[Pattern]] = {}
    frees: list[int] = []
    done: Counter[Pattern] = Counter()

    def put(pattern: Pattern, free: int, n: int) -> None:
        if not n:
            return
        if not free:
            done[pattern] += n
            return
        if free not in open_bins:
            open_bins[free] = Counter()
            bisect.insort(frees, free)
        open_bins[free][pattern] += n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(frees, length)
            if at < len(frees):
                free = frees[at]
                pattern, n = open_bins[free].popitem()
                if not open_bins[free]:
                    del open_bins[free]
                    frees.pop(at)
            else:
                free, pattern, n = capacity, (), left
            # the fullest bin that has room takes items until it has none
            each = free // length
            k = min(n, left // each)
            if k:
                put(pattern + (length,) * each, free - each * length, k)
                left -= k * each
            if left and k < n and left < each:
                put(pattern + (length,) * left, free - left * length, 1)
                left, k = 0, k + 1
            if pattern:
                put(pattern, free, n - k)
    for bins in open_bins.values():
        done.update(bins)
    return done


class _Underfull:
    """Bin patterns with multiplicities, and an index of the underfull ones by free space and by the items they hold."""

    def __init__(self, bins: Counter[Pattern], capacity: int):
        self.capacity, self.bins = capacity, Counter()
        self.of: dict[tuple[int, int], dict[Pattern, None]] = defaultdict(dict)
        #: [free space, item]: how many patterns; item 0 stands for any pattern
        self.has = np.zeros((capacity + 1, capacity + 1), np.int32)
        for pattern, n in bins.items():
            self.add(pattern, n)

    def add(self, pattern: Pattern, n: int) -> None:
        pattern = tuple(sorted(pattern, reverse=True))
        free = self.capacity - sum(pattern)
        if pattern and free and pattern not in self.bins:
            for y in {0, *pattern}:
                self.of[free, y][pattern] = None
                self.has[free, y] += 1
        if pattern:
            self.bins[pattern] += n

    def take(self, pattern: Pattern, n: int) -> None:
        self.bins[pattern] -= n
        free = self.capacity - sum(pattern)
        if not self.bins[pattern]:
            del self.bins[pattern]
            for y in {0, *pattern} if free else ():
                del self.of[free, y][pattern]
                self.has[free, y] -= 1

    def emptiest_first(self):
        for free in np.flatnonzero(self.has[:, 0])[::-1].tolist():
            yield from list(self.of[free, 0])

    def exchange(self, a: Pattern) -> tuple[Pattern, Pattern, Pattern] | None:
        """(b, out, back): the move, one-for-one or two-for-one exchange that leaves least room in a bin b at least as full as a."""
        free = self.capacity - sum(a)
        pairs = {(x, y) for i, x in enumerate(a) for y in a[i + 1 :]}
        outs = [(x,) for x in sorted(set(a), reverse=True)] + sorted(pairs, reverse=True)
        # exchanges that fill b to a few tokens lie on diagonals of the index
        for room in range(NEAR):
            for out in outs:
                size = sum(out)
                f = np.arange(max(room + 1, size + room - self.capacity), min(free, size + room - len(out) + 1) + 1)
                for k in np.flatnonzero(self.has[f, size - f + room]).tolist() if len(f) else ():
                    if found := self._target(a, int(f[k]), size - int(f[k]) + room):
                        return found[0], out, found[1]
        best: tuple[int, tuple | None] = (self.capacity, None)
        frees = np.flatnonzero(self.has[1 : free + 1, 0]) + 1
        held = self.has[frees] > 0
        for out in outs:
            size, least = sum(out), len(out) - 1
            f, y = np.nonzero(held[:, least:size])
            f, y = frees[f], y + least
            room = f + y - size
            fits = np.flatnonzero((room >= 0) & (room < best[0]))
            for k in fits[np.argsort(room[fits], kind="stable")].tolist():
                if found := self._target(a, int(f[k]), int(y[k])):
                    best = int(room[k]), (found[0], out, found[1])
                    break
        return best[1]

    def _target(self, a: Pattern, free: int, item: int) -> tuple[Pattern, Pattern] | None:
        b = next((b for b in self.of[free, item] if b != a or self.bins[a] > 1), None)
        return None if b is None else (b, (item,) if item else ())


#: Tokens of room up to which an exchange counts as filling a bin, and is taken before others are compared.
NEAR = 4


def local_search(bins: Counter[Pattern], capacity: int) -> tuple[Counter[Pattern], int]:
    """Exchange documents between underfull bins, from the emptiest one, while the sum of squared fills grows; emptied bins go.

    Returns the bins and the number of exchanges (each of a group of like bins).  Ends at the least possible number of bins or when
    no exchange is left: the sum of squares grows with every step, so it does end.
    """
    state, steps = _Underfull(bins, capacity), 0
    count = sum(bins.values())
    least = -(-sum(sum(p) * n for p, n in bins.items()) // capacity)
    tired: set[Pattern] = set()
    while count > least:
        for a in state.emptiest_first():
            if a not in tired and (found := state.exchange(a)):
                break
            tired.add(a)
        else:
            if all(state.exchange(a) is None for a in state.emptiest_first()):
                break
            tired.clear()
            continue
        b, out, back = found
        n = state.bins[a] // 2 if a == b else min(state.bins[a], state.bins[b])
        left, right = list((Counter(a) - Counter(out) + Counter(back)).elements()), list((Counter(b) - Counter(back) + Counter(out)).elements())
        state.take(a, n)
        state.take(b, n)
        state.add(tuple(left), n)
        state.add(tuple(right), n)
        steps += 1
        if not left:
            count -= n
            tired.clear()
    return state.bins, steps


def places(bins: Counter[Pattern]) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: where pieces of a length and rank go."""
    rows, used, sequence = [], Counter(), 0
    for pattern in sorted(bins):
        n, offset = bins[pattern], 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All pieces with their sequence and offset."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    cut = materialise(pieces(docs, path, capacity, id_col, text_col), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(local_search(best_fit(histogram, capacity), capacity)[0])
    held = spark.sparkContext.broadcast(table)
    blocks = -(-max(histogram.values(), default=1) // RANK_BLOCK)
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    sizes = dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sizes = materialise(sizes.select("length", "block", F.coalesce(before, F.lit(0)).cast("long").alias("before")), "ranks")
    own = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("own", own).join(sizes, ["length", "block"])
    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).alias("rank"))

    def place(batches):
        t = held.value
        key = (t[:, 0] << 44) | t[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(key, (length << 44) | rank, "right") - 1
            found = [pa.array(t[at, 2] + rank - t[at, 1]), pa.array(t[at, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
