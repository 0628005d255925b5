"""Suffix-array dedup of byte strings of a least length by deep-shallow sorting.

A first scan finds the text that can repeat at all: each ``length``-byte window is marked by the least hash of its
short grams, equal windows have equal marks, and marks that occur in one document only (proven by a fixed-size
filter) rule their windows out; whole copies of a smaller document need no search.  What is left are *pieces*:
runs of windows with one mark, with their bytes.  Pieces are combined before they move, in compressed blocks, and
go to tasks by range of mark, so equal windows meet; a task holds one such range (bucket) at a time.  There the suffixes at
all window starts are sorted: multikey quicksort (pivot and ternary split, 8-byte characters, all groups of a bucket advancing
together) to a shallow depth, then a blind trie for each group that agrees so far and branches later, down to ``length``
bytes.  Suffixes that end in one group hold the same string; the smallest document of the group tells which
occurrences go.  Spans are merged and the bytes removed.

Classes (pieces of one mark) beyond ``CLASS_LIMIT`` different pieces are spread over tasks by the windows' own bytes, a
plain count that is combined before its shuffle, so no task holds an unbounded class.

Defined results: null text is empty; rows with a null id have no place in the order: nothing is removed from them or
on their account; rows that repeat an id are separate texts, none of which counts as smaller than another.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import BASE, gram_hashes, mix, prefix_hash, slice_hash, sliding_min, text_chunks
from .common import BROADCAST_IDS, FILTER_WORDS, data_width, key_filter_words, materialise, read_table
from .removal import apply_spans, with_row_key
from .sieve import bucket_bits, marked, repeat_filter

LENGTH, GRAM, SHALLOW = 50, 18, 16
#: Windows in one piece at most, and different pieces of one mark that a task sorts.
RUN, CLASS_LIMIT = 64, 100_000
#: Pieces that a task holds before it sends them off.
FLUSH = 200_000


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For each run of windows with one mark: its mark, document, first position and number of windows."""
    if len(data) < length:
        return None
    mark = sliding_min(gram_hashes(data.astype(np.uint64) + np.uint64(1), gram), length - gram + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = doc[: len(mark)] == doc[length - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return None
    mark, doc = mark[at], doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    if n.max() > RUN:  # periodic text: cut long runs
        parts = -(-n // RUN)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        n = np.minimum(RUN, np.repeat(n, parts) - RUN * k)
        first = np.repeat(first, parts) + RUN * k
    # minima crowd at the low end: mixed again, they spread evenly over filters and buckets
    return mix(mark[first]), doc[first], at[first], n


def words_at(data: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte word at every position (zero beyond the end)."""
    padded = np.zeros(len(data) + 8, np.uint64)
    padded[: len(data)] = data
    w = np.zeros(len(data), np.uint64)
    for k in range(8):
        w |= padded[k : k + len(data)] << np.uint64(56 - 8 * k)
    return w


def multikey_quicksort(character, order: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the groups of ``order`` that begin at ``starts`` by their characters up to ``depth``: order and group starts.

    Each round splits every open group at once into the smaller, equal and larger ones around its pivot (the median of three
    characters); the equal part goes on at the next character.  ``character(suffixes, depths)`` gives 8-byte characters.
    """
    order, final = order.copy(), []
    size = np.diff(np.append(starts, len(order)))
    at = np.zeros(len(starts), np.int64)
    while True:
        closed = (size < 2) | (at >= depth)
        final.append(starts[closed])
        starts, size, at = starts[~closed], size[~closed], at[~closed]
        if not len(starts):
            return order, np.sort(np.concatenate(final))
        edge = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(starts - edge, size)
        own = order[place]
        c = character(own, np.repeat(at, size))
        low, mid, high = c[edge], c[edge + size // 2], c[edge + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(low, mid), np.minimum(np.maximum(low, mid), high)), size)
        less, same = c < pivot, c == pivot
        n_less, n_same = np.add.reduceat(less, edge, dtype=np.int64), np.add.reduceat(same, edge, dtype=np.int64)
        # ternary split: a row's new place is its part's start and its rank in that part
        base = np.where(less, 0, np.where(same, np.repeat(n_less, size), np.repeat(n_less + n_same, size)))
        rank = np.empty(len(c), np.int64)
        for part in (less, same, ~(less | same)):
            before = np.cumsum(part) - part
            rank[part] = (before - np.repeat(before[edge], size))[part]
        order[np.repeat(starts, size) + base + rank] = own
        parts = [(starts, n_less, at), (starts + n_less, n_same, at + 8), (starts + n_less + n_same, size - n_less - n_same, at)]
        starts, size, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
        starts, size, at = starts[size > 0], size[size > 0], at[size > 0]


class _Branch:
    """A node of a blind trie: the position at which its strings differ, and a child for each byte there."""

    __slots__ = ("at", "children")

    def __init__(self, at: int, children: dict):
        self.at, self.children = at, children


class BlindTrie:
    """Strings of one length by their branching positions only; a leaf holds one string and all that are equal to it."""

    def __init__(self):
        self.root: _Branch | tuple | None = None

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (string, [member])
            return
        # blind search: bytes between branching positions are skipped; without a child any path down will do
        node = self.root
        while isinstance(node, _Branch):
            node = node.children.get(string[node.at]) or next(iter(node.children.values()))
        # verification against the leaf that was found
        if node[0] == string:
            node[1].append(member)
            return
        differ = int.from_bytes(string, "big") ^ int.from_bytes(node[0], "big")
        at, other = len(string) - (differ.bit_length() + 7) // 8, node[0]
        # insertion at the first byte that differs
        parent, node = None, self.root
        while isinstance(node, _Branch) and node.at < at:
            parent, node = node, node.children[string[node.at]]
        if isinstance(node, _Branch) and node.at == at:
            node.children[string[at]] = (string, [member])
            return
        branch = _Branch(at, {string[at]: (string, [member]), other[at]: node})
        if parent is None:
            self.root = branch
        else:
            parent.children[string[parent.at]] = branch

    def groups(self) -> list[list[int]]:
        """Members of equal strings, in the strings' order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node, _Branch):
                stack.extend(node.children[b] for b in sorted(node.children, reverse=True))
            else:
                out.append(node[1])
        return out


def sort_suffixes(data: np.ndarray, at: np.ndarray, length: int, shallow: int = SHALLOW, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``at`` by their first ``length`` bytes, and a group number each (equal strings share it).

    The group numbers belong to the sorted order and do not fall.  With ``starts``, the runs of suffixes that begin there are sorted
    on their own (equal strings must be in one run).
    """
    word = words_at(data)

    def character(i: np.ndarray, depth) -> np.ndarray:
        return word[at[i] + depth] >> (np.maximum(0, depth + 8 - length) * 8).astype(np.uint64)

    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, first = multikey_quicksort(character, np.arange(len(at)), np.zeros(1, np.int64) if starts is None else starts, min(shallow, length))
    size = np.diff(np.append(first, len(order)))
    new = np.zeros(len(order), bool)
    new[first] = True
    # deep: groups that agree on all that is left are done, the others go to blind tries
    lead = order[np.repeat(first, size)]
    agree = np.ones(len(order), bool)
    for depth in range(min(shallow, length), length, 8):
        agree &= character(order, np.int64(depth)) == character(lead, np.int64(depth))
    raw = None
    for k in np.flatnonzero(~np.logical_and.reduceat(agree, first)):
        raw = data.tobytes() if raw is None else raw
        trie, lo = BlindTrie(), first[k]
        for i in order[lo : lo + size[k]].tolist():
            trie.insert(raw[at[i] + shallow : at[i] + length], i)
        for members in trie.groups():
            order[lo : lo + len(members)] = members
            new[lo] = True
            lo += len(members)
    return order, np.cumsum(new) - 1


def resolve(data: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int, limit: int):
    """Of the pieces that lie one after another in ``data``: rows (piece hash, first or -1, packed firsts or None, low, high, bytes)
    where a window repeats across documents.

    ``low`` and ``high`` are the smallest and largest document of a piece; a first is the smallest document of a window.
    Pieces of classes with more than ``limit`` different pieces come back as they are (their first is None).
    """
    start = np.cumsum(sizes) - sizes
    piece = slice_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1), BASE), start, start + sizes, BASE)
    mark = sliding_min(gram_hashes(data.astype(np.uint64) + np.uint64(1), gram), length - gram + 1)[start]
    order = np.lexsort((piece, mark))
    mark, piece, low, high, start, sizes = (x[order] for x in (mark, piece, low, high, start, sizes))
    at = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (mark[1:] != mark[:-1])])
    low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
    mark, piece, start, sizes = mark[at], piece[at], start[at], sizes[at]
    name = piece.astype(np.int64)
    _, klass, members = np.unique(mark, return_inverse=True, return_counts=True)
    members = members[klass]
    for i in np.flatnonzero((members == 1) & (high > low)):
        yield int(name[i]), int(low[i]), None, None, None, None
    for i in np.flatnonzero(members > limit):
        yield int(name[i]), None, None, int(low[i]), int(high[i]), data[start[i] : start[i] + sizes[i]].tobytes()
    several = np.flatnonzero((members > 1) & (members <= limit))
    if not len(several):
        return
    windows = sizes[several] - length + 1
    edge = np.cumsum(windows) - windows
    of = np.repeat(several, windows)
    place = start[of] + np.arange(windows.sum()) - np.repeat(edge, windows)
    # equal windows have equal marks, so each class is sorted on its own
    rank, group = sort_suffixes(data, place, length, starts=np.flatnonzero(np.r_[True, np.diff(klass[of]) != 0]))
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.minimum.reduceat(low[of[rank]], first)
    firsts = np.empty(len(of), np.int64)
    firsts[rank] = least[group]
    lowest, highest = np.minimum.reduceat(firsts, edge), np.maximum.reduceat(firsts, edge)
    for k in np.flatnonzero(high[several] > lowest):
        i = several[k]
        if lowest[k] == highest[k]:
            yield int(name[i]), int(lowest[k]), None, None, None, None
        else:
            yield int(name[i]), -1, firsts[edge[k] : edge[k] + windows[k]].tobytes(), None, None, None


def _pack(sizes: np.ndarray, low: np.ndarray, high: np.ndarray, text: bytes) -> bytes:
    """Pieces as one compressed block; hashes are left out, a reader makes them again from the bytes."""
    raw = np.int64(len(sizes)).tobytes() + sizes.astype(np.uint8).tobytes() + low.astype(np.int64).tobytes() + (high - low).astype(np.int64).tobytes() + text
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = pa.decompress(block[8:], int(np.frombuffer(block, np.int64, 1)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    low = np.frombuffer(raw, np.int64, n, 8 + n)
    return np.frombuffer(raw, np.uint8, n, 8).astype(np.int64), low, low + np.frombuffer(raw, np.int64, n, 8 + 9 * n), raw[8 + 17 * n :]


def exact_copies(rows: DataFrame, length: int) -> DataFrame:
    """(key, n): documents whose whole text is that of a smaller document; all their bytes go, if they have enough."""
    digests = rows.where("id is not null and t is not null").select("id", "key", F.octet_length("t").cast("long").alias("n"), F.sha2(F.col("t").cast("binary"), 256).alias("d"))
    digests = materialise(digests.where(F.col("n") >= length), "digests")
    shared = digests.groupBy("d").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    shared = materialise(shared.select("d", "first"), "shared")  # both sides of the join are then plain exchanges that can be split
    return digests.join(shared, "d").where("id > first").select("key", "n")


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, span): byte intervals to remove, from rows of id, t, key."""
    spark = rows.sparkSession
    copies = materialise(exact_copies(rows, length), "copies")
    numbered = rows.where("id is not null and t is not null").select("id", "t", "key")
    # copies need no search: a bounded number of them is skipped where rows are read, more are taken out by a join
    if copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        skip = spark.sparkContext.broadcast(np.sort(copies.select("key").toArrow().column(0).to_numpy()))
    else:
        skip = spark.sparkContext.broadcast(np.zeros(0, np.int64))
        numbered = numbered.join(copies.select("key"), "key", "left_anti").select("id", "t", "key")

    def fresh(batch):
        keys, gone = batch.column(2).to_numpy(), skip.value
        if not len(gone):
            return batch
        at = np.minimum(np.searchsorted(gone, keys), len(gone) - 1)
        return batch.filter(pa.array(gone[at] != keys))

    def marks(batch):
        base, batch = 0, fresh(batch)
        for lo, hi, data, offsets in text_chunks(batch.column(1)):
            if found := _runs(data, offsets, length, gram):
                yield found[0], found[1] + base
            base += hi - lo

    held = spark.sparkContext.broadcast(repeat_filter(numbered, ["id", "t", "key"], marks))

    bits = bucket_bits(numbered, 1 << 18, 20)

    def chosen(batch):
        """Runs that may repeat, with the hashes of their pieces."""
        for lo, _, data, offsets in text_chunks(batch.column(1)):
            if found := _runs(data, offsets, length, gram):
                may = marked(held.value, found[0])
                mark, doc, at, n = (x[may] for x in found)
                if len(mark):
                    piece = slice_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1), BASE), at, at + n + length - 1, BASE)
                    yield lo, data, offsets, mark, doc, at, n, piece

    def distinct(batches):
        """Different pieces of a part of the input, as compressed blocks by range of mark."""
        pending, size = [], 0

        def flush():
            mark, piece, ids, n, texts = (np.concatenate([p[k] for p in pending]) if k < 4 else [t for p in pending for t in p[4]] for k in range(5))
            order = np.lexsort((ids, piece))
            p, i = piece[order], ids[order]
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            own, low, high = order[first], i[first], i[np.append(first[1:], len(p)) - 1]
            bucket = (mark[own] >> np.uint64(64 - bits)).astype(np.int64)
            step = np.argsort(bucket, kind="stable")
            own, low, high, bucket = own[step], low[step], high[step], bucket[step]
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            blocks = [_pack(n[own[a:b]], low[a:b], high[a:b], b"".join(texts[k] for k in own[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), pa.array(blocks, pa.binary())], names=["bucket", "block"])

        for batch in batches:
            batch = fresh(batch)
            ids = batch.column(0).to_numpy()
            for lo, data, _, mark, doc, at, n, piece in chosen(batch):
                raw = data.tobytes()
                bytes_ = n + length - 1
                pending.append((mark, piece, ids[lo + doc], bytes_, [raw[a : a + m] for a, m in zip(at.tolist(), bytes_.tolist(), strict=True)]))
                size += len(mark)
                if size > FLUSH:
                    yield flush()
                    pending, size = [], 0
        if size:
            yield flush()

    def solve(own, out):
        parts = [_unpack(b) for b in own]
        sizes, low, high = (np.concatenate([p[k] for p in parts]) for k in range(3))
        out.extend(resolve(np.frombuffer(b"".join(p[3] for p in parts), np.uint8), sizes, low, high, length, gram, CLASS_LIMIT))

    def sort(batches):
        """The rows come sorted by bucket, so one bucket at a time is held."""
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())

        def made(out):
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "first", "firsts", "low", "high", "bytes"])

        key, own, out = None, [], []
        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != key and own:
                    solve(own, out)
                    own = []
                    if len(out) > 10_000:
                        yield made(out)
                        out = []
                key = k
                own.append(b.as_py())
        if own:
            solve(own, out)
        if out:
            yield made(out)

    classes = numbered.mapInArrow(distinct, "bucket long, block binary").repartition(data_width(numbered), "bucket").sortWithinPartitions("bucket")
    solved = materialise(classes.mapInArrow(sort, "piece long, first long, firsts binary, low long, high long, bytes binary"), "solved")
    firsts = solved.where("first is not null").select("piece", "first", "firsts")
    if not solved.where("first is null").isEmpty():
        firsts = firsts.unionByName(_large_classes(solved.where("first is null"), length))
    # a second fixed-size filter: pieces without an entry need not travel
    wanted = spark.sparkContext.broadcast(key_filter_words(firsts.select("piece"), "piece", by_value=True))

    def places(batches):
        for batch in batches:
            batch = fresh(batch)
            ids, keys = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for lo, _, offsets, _, doc, at, n, piece in chosen(batch):
                name = piece.astype(np.int64)
                h = name & ((1 << 62) - 1)
                may = (wanted.value[h % FILTER_WORDS] >> ((h >> 40) % 64)) & 1 == 1
                doc, at, n = doc[may], at[may], n[may]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[may]), pa.array(ids[lo + doc]), pa.array(keys[lo + doc]), pa.array(((at - offsets[doc]) << 8) | n)],
                    names=["piece", "id", "key", "run"])

    found = numbered.mapInArrow(places, "piece long, id long, key long, run long")
    if rows.where("key <> id").isEmpty():
        found = found.drop("key").withColumn("key", F.col("id"))
    hits = found.join(firsts, "piece").where("firsts is not null or id > first").select("key", "id", "run", "firsts")

    def spans(batches):
        for batch in batches:
            keys, ids, run = (batch.column(k).to_numpy() for k in (0, 1, 2))
            at, n = run >> 8, run & 255
            blobs, own = [], []
            for i, f in enumerate(batch.column(3)):
                f = f.as_py()
                if f is None:
                    blobs.append(np.array([at[i], at[i] + n[i] + length - 1], np.int64).tobytes())
                    own.append(i)
                else:
                    gone = np.flatnonzero(np.frombuffer(f, np.int64) < ids[i])
                    if len(gone):
                        cut = np.flatnonzero(np.diff(gone) > 1)
                        lo, hi = gone[np.r_[0, cut + 1]], gone[np.r_[cut, len(gone) - 1]]
                        blobs.append((np.column_stack([lo, hi + length]) + at[i]).tobytes())
                        own.append(i)
            # spans of one document in a batch travel together
            keys = keys[own]
            order = np.argsort(keys, kind="stable")
            k = keys[order]
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
            joined = [b"".join(blobs[j] for j in order[a:b]) for a, b in zip(first, np.append(first[1:], len(k)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(k[first]), pa.array(joined, pa.binary())], names=["key", "span"])

    def whole(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array([0, n], np.int64).tobytes() for n in batch.column(1).to_pylist()], pa.binary())], names=["key", "span"])

    out = "key long, span binary"
    return hits.mapInArrow(spans, out).unionByName(copies.mapInArrow(whole, out))


def _large_classes(pieces: DataFrame, length: int) -> DataFrame:
    """Firsts of the pieces of classes that no task should hold: windows are counted by their bytes."""
    one = pieces.groupBy("piece", "bytes").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    windows = one.select("piece", "low", "bytes", F.posexplode(F.sequence(F.lit(1), F.octet_length("bytes") - (length - 1))).alias("k", "s"))
    windows = windows.select("piece", "low", "k", F.expr(f"substring(bytes, s, {length})").alias("w"))
    least = windows.groupBy("w").agg(F.min("low").alias("f"))
    lists = windows.join(least, "w").groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("k", "f"))).alias("x"))

    def pack(batches):
        for batch in batches:
            out = [np.array([p["f"] for p in x.as_py()], np.int64).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([-1] * len(out), pa.int64()), pa.array(out, pa.binary())], names=["piece", "first", "firsts"])

    return lists.mapInArrow(pack, "piece long, first long, firsts binary")


def _finish(text: bytes, spans: np.ndarray | None) -> tuple:
    if spans is None:
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    left, at = [], 0
    for lo, hi in spans.tolist():
        left.append(text[at:lo])
        at = hi
    kept = b"".join([*left, text[at:]])
    return len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the digest of the bytes kept."""
    rows = with_row_key(docs, id_col, text_col)
    return apply_spans(rows, repeated_spans(rows, length), _finish, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
