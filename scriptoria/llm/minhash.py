"""Near-duplicate detection by an inverted join over MinHash signature coordinates.

Documents with one shingle set form a class, represented by its smallest id; only representatives are joined.
A representative is posted under (coordinate, value) pairs of its signature.  Two documents that agree on at
least ``threshold`` of the ``coordinates`` share a pair among the ``coordinates - threshold + 1`` first ones of
each, in any common order of the pairs; the order takes rare pairs first (a fixed-size sketch of frequencies),
so values of common passages are hardly ever posted.
Collisions in a posting list are first tried against the list's smallest document, a number of comparisons linear in
the list: signatures that agree form *clusters*, and pairs confirmed on the full shingle sets form *components*.
Two kinds of pairs remain, and both are compared in full, in blocks of bounded size: members of one list in
different clusters, by counting collisions with prefix and skip merging (pairs at the threshold are confirmed); and members of one
cluster in different components, by their sets at once, where each unit only returns the links that join its
components.  So no list is capped, and no group of copies is expanded into all pairs.

With 64 coordinates and threshold 40, two documents at Jaccard 0.85 are missed with probability about 1e-6.

Defined results: a null text, or a text without words, has an empty set and is linked with nothing; fewer words
than a shingle make one shingle of all words; rows that repeat an id count as one document (their texts' classes
are linked through it); rows with a null id are returned unlinked.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import LOWER_ASCII, gram_hashes, mix, text_chunks, word_hashes, words
from .common import FILTER_WORDS, key_filter_words, materialise, mixed, read_table, without_ids
from .components import components
from .sieve import cell_of, count_sketch

COORDINATES, THRESHOLD, SHINGLE, BLOCK = 64, 40, 5, 512
#: Bytes of shingle sets in a block, about.
UNIT_BYTES = 8 << 20
#: Rows up to which collisions of all wanted pairs are counted at once: setting up posting lists would cost more than they save.
FEW_ROWS = 64


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        a = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        b = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return a, b


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """For each document its sorted distinct shingle hashes."""
    low = LOWER_ASCII[data]
    starts, ends, first = words(low, offsets)
    hashes = word_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, k)
    for i in range(len(offsets) - 1):
        lo, hi = first[i], first[i + 1]
        n = hi - lo
        if n >= k:
            yield np.unique(grams[lo : hi - k + 1])
        elif n:
            yield gram_hashes(hashes[lo:hi], n) ^ np.uint64(n)
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of len(a) permutations, 32 bits each."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(shingles), 4096):
        part = shingles[lo : lo + 4096, None] * a[None, :] + b[None, :]
        np.minimum(out, (part.min(axis=0) >> np.uint64(32)).astype(np.uint32), out=out)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """id, n_shingles, set_key (128-bit digest of the set), sig (packed coordinates)."""

    def scan(batches):
        a, b = _seeds(coordinates)
        for batch in batches:
            n, key, sig = [], [], []
            for _, _, data, offsets in text_chunks(batch.column(1)):
                for s in shingle_sets(data, offsets, k):
                    n.append(len(s))
                    key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(signature(s, a, b).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], names=["id", "n_shingles", "set_key", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(scan, "id long, n_shingles long, set_key binary, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Packed signatures of a batch as rows of coordinates."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), -1) if values else np.zeros((0, 1), np.uint32)


def _pair_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each (coordinate, value) pair."""
    return mix((np.arange(1, sig.shape[1] + 1, dtype=np.uint64) << np.uint64(32))[None, :] | sig.astype(np.uint64))


def postings(reps: DataFrame, coordinates: int, threshold: int) -> DataFrame:
    """(pair, id): each representative under its prefix of rare pairs."""
    sketch = count_sketch(reps, ["sig"], lambda batch: [_pair_keys(_matrix(batch.column(0))).ravel()])
    held = reps.sparkSession.sparkContext.broadcast(sketch)
    prefix = coordinates - threshold + 1

    def post(batches):
        for batch in batches:
            keys = _pair_keys(_matrix(batch.column(1)))
            if not len(keys):
                continue
            cells = cell_of(held.value, keys.ravel()).reshape(keys.shape)
            # one total order for all: by cell, then by key
            rank = (cells.astype(np.uint64) << np.uint64(56)) | (keys >> np.uint64(8))
            first = np.argsort(rank, axis=1, kind="stable")[:, :prefix]
            chosen = np.take_along_axis(keys, first, 1)
            ids = np.repeat(batch.column(0).to_numpy(), prefix)
            yield pa.RecordBatch.from_arrays([pa.array(chosen.ravel().astype(np.int64)), pa.array(ids)], names=["pair", "id"])

    return reps.select("id", "sig").mapInArrow(post, "pair long, id long")


def agreeing(pairs: DataFrame, sigs: DataFrame, threshold: int) -> DataFrame:
    """Pairs (u, v) whose signatures agree on ``threshold`` coordinates."""
    s = sigs.select("id", "sig")
    both = (
        pairs.join(s.withColumnsRenamed({"id": "u", "sig": "su"}), "u").join(s.withColumnsRenamed({"id": "v", "sig": "sv"}), "v")
        .select("u", "v", "su", "sv")
    )

    def test(batches):
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1) >= threshold
                yield batch.select([0, 1]).filter(pa.array(same))

    return both.mapInArrow(test, "u long, v long")


def shingle_table(docs: DataFrame, pairs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of the documents of some pairs (and perhaps of a few others): a fixed-size filter picks them."""
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v"))
    held = docs.sparkSession.sparkContext.broadcast(key_filter_words(ids, "id"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).where("id is not null")
    rows = rows.withColumn("h", mixed(F.col("id")))

    def sets(batches):
        filt = held.value
        for batch in batches:
            h = batch.column(2).to_numpy()
            may = (filt[h % FILTER_WORDS] >> ((h >> 40) % 64)) & 1 == 1
            batch = batch.filter(pa.array(may))
            out = []
            for _, _, data, offsets in text_chunks(batch.column(1)):
                out.extend(s.tobytes() for s in shingle_sets(data, offsets, k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "shingles"])

    return materialise(rows.mapInArrow(sets, "id long, shingles binary"), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, numerator: int) -> DataFrame:
    """Pairs (u, v) with 100 * |intersection| >= numerator * |union| on their full shingle sets."""
    both = (
        pairs.join(sets.withColumnsRenamed({"id": "u", "shingles": "su"}), "u")
        .join(sets.withColumnsRenamed({"id": "v", "shingles": "sv"}), "v").select("u", "v", "su", "sv")
    )

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = np.intersect1d(p, q, assume_unique=True).size
                keep.append(shared > 0 and 100 * shared >= numerator * (len(p) + len(q) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(test, "u long, v long").distinct()


def _units(rows: DataFrame, group: str, payload: str, block: int) -> DataFrame:
    """Deal the rows of each group (with its size n, perhaps its bytes) into blocks; a unit is a pair of blocks: (group, b1, b2), about
    2 * block rows and 2 * UNIT_BYTES at most.  Rows: unit's three keys, own block, id, part, payload, sorted by unit."""
    dealt = (
        rows.withColumn("nb", F.greatest(F.ceil(F.col("n") / block), *([F.ceil(F.col("bytes") / UNIT_BYTES)] if "bytes" in rows.columns else [F.lit(1)])).cast("long")).withColumn("b", F.pmod(F.xxhash64("id"), F.col("nb")))
        .select(group, "id", "part", payload, "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("c"))
        .select(group, F.least("b", "c").alias("b1"), F.greatest("b", "c").alias("b2"), "b", "id", "part", payload)
    )
    return dealt.repartition(group, "b1", "b2").sortWithinPartitions(group, "b1", "b2")


def _by_unit(compare):
    """Run ``compare(rows of a unit)``, which yields pairs, over the sorted rows of a partition."""

    def scan(batches):
        unit, key = [], None
        out: list[tuple[int, int]] = []

        def done():
            u, v = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if len(unit) > 1:
                        out.extend(compare(unit))
                    unit, key = [], row[:3]
                unit.append(row)
                if len(out) > 50_000:
                    yield done()
                    out.clear()
        if len(unit) > 1:
            out.extend(compare(unit))
        if out:
            yield done()

    return scan


def _unit_columns(unit):
    return (np.array([r[k] for r in unit], np.int64) for k in (3, 4, 5))


def collisions(sig: np.ndarray, threshold: int, wanted):
    """Pairs (i, j) of signatures that agree on ``threshold`` coordinates, j among the rows that ``wanted(i)`` marks.

    Rows are posted under their coordinate-value pairs.  For row i the lists are taken by length: one of any
    ``coordinates - threshold + 1`` lists holds a match, so collisions are counted over the shortest ones (the prefix); the long lists
    are not merged but looked up for the rows met so far, and a row is skipped as soon as it cannot reach the threshold.
    Up to ``FEW_ROWS`` rows need no lists.  ``wanted`` also takes a column of rows and then marks a matrix.
    """
    n, coordinates = sig.shape
    if n <= FEW_ROWS:
        i, j = np.nonzero(wanted(np.arange(n)[:, None]))
        same = (sig[i] == sig[j]).sum(axis=1) >= threshold
        yield from zip(i[same].tolist(), j[same].tolist(), strict=True)
        return
    prefix = coordinates - threshold + 1
    order = np.argsort(sig, axis=0, kind="stable")
    ranked = np.take_along_axis(sig, order, 0)
    start, size = np.empty((n, coordinates), np.int64), np.empty((n, coordinates), np.int64)
    for c in range(coordinates):
        first = np.flatnonzero(np.r_[True, ranked[1:, c] != ranked[:-1, c]])
        length = np.diff(np.append(first, n))
        start[order[:, c], c], size[order[:, c], c] = np.repeat(first, length), np.repeat(length, length)
    by_length = np.argsort(size, axis=1, kind="stable")
    for i in range(n):
        other = wanted(i)
        if not other.any():
            continue
        count = np.zeros(n, np.int64)
        for c in by_length[i, :prefix].tolist():
            if size[i, c] > 1:
                count[order[start[i, c] : start[i, c] + size[i, c], c]] += 1
        at = np.flatnonzero((count > 0) & other)
        have, left = count[at], threshold - 1
        for lo in range(prefix, coordinates, 8):
            if not len(at):
                break
            some = by_length[i, lo : lo + 8]
            have = have + (sig[np.ix_(at, some)] == sig[i, some]).sum(axis=1)
            left -= len(some)
            may = have + left >= threshold
            at, have = at[may], have[may]
        for j in at[have >= threshold].tolist():
            yield i, j


def agreeing_in_lists(lists: DataFrame, sigs: DataFrame, threshold: int, block: int = BLOCK) -> DataFrame:
    """Pairs of different parts inside posting lists (pair, id, part, n) whose signatures agree on the threshold."""

    def compare(unit):
        b, ids, part = _unit_columns(unit)
        sig = np.frombuffer(b"".join(r[6] for r in unit), np.uint32).reshape(len(unit), -1)
        cross = unit[0][1] != unit[0][2]
        for i, j in collisions(sig, threshold, lambda i: (part != part[i]) & (ids > ids[i]) & ((b != b[i]) if cross else True)):
            yield int(ids[i]), int(ids[j])

    return _units(lists.join(sigs.select("id", "sig"), "id"), "pair", "sig", block).mapInArrow(_by_unit(compare), "u long, v long").distinct()


def joining_links(clusters: DataFrame, sets: DataFrame, numerator: int, block: int = BLOCK) -> DataFrame:
    """Links between different components (part) inside clusters (cluster, id, part, n), on full sets: of each unit a
    set of links that joins all its rows that links join."""

    def compare(unit):
        # an id that repeats may have an empty text besides the one that put it here
        unit = [r for r in unit if r[6]]
        if len(unit) < 2:
            return
        b, ids, part = _unit_columns(unit)
        own = [np.frombuffer(r[6], np.uint64) for r in unit]
        size = np.array([len(x) for x in own])
        vocabulary, flat = np.unique(np.concatenate(own), return_inverse=True)
        edge = np.cumsum(size) - size
        label = part.copy()
        names, counts = np.unique(part, return_counts=True)
        largest = names[np.argmax(counts)]
        cross = unit[0][1] != unit[0][2]
        mask = np.zeros(len(vocabulary), np.int32)
        # every pair of two components has a member outside the largest one
        for i in np.flatnonzero(part != largest):
            other = label != label[i]
            if cross:
                other &= b != b[i]
            if not other.any():
                continue
            mine = flat[edge[i] : edge[i] + size[i]]
            mask[mine] = 1
            shared = np.add.reduceat(mask[flat], edge)
            mask[mine] = 0
            for j in np.flatnonzero(other & (shared > 0) & (100 * shared >= numerator * (size + size[i] - shared))):
                if label[j] != label[i]:
                    yield int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))
                    label[label == label[j]] = label[i]

    return _units(clusters.join(sets, "id"), "cluster", "shingles", block).mapInArrow(_by_unit(compare), "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", numerator: int = 80, shingle: int = SHINGLE,
    coordinates: int = COORDINATES, threshold: int | None = None,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    ``numerator`` is the least similarity in hundredths.  The match threshold follows from it when not given:
    five standard deviations below the agreement expected at that similarity.
    """
    if threshold is None:
        j = numerator / 100
        threshold = max(1, int(coordinates * j - 5 * (coordinates * j * (1 - j)) ** 0.5))
    sigs = materialise(signatures(docs, id_col, text_col, shingle, coordinates), "signatures")
    filled = sigs.where("set_key is not null and id is not null")
    classes = filled.groupBy("set_key", "n_shingles").agg(F.min("id").alias("rep"))
    classes = materialise(classes, "classes")  # plain exchanges on both sides: a hot class can be split
    members = filled.select("id", "set_key", "n_shingles").join(classes, ["set_key", "n_shingles"]).select("id", "rep")
    members = materialise(members.distinct(), "members")
    reps = materialise(filled.join(classes.select(F.col("rep").alias("id"), "set_key"), ["id", "set_key"], "left_semi").select("id", "sig", "n_shingles").distinct(), "reps")

    every = materialise(postings(reps, coordinates, threshold), "every-posting")
    lists = every.groupBy("pair").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = materialise(lists, "lists")
    posted = materialise(every.join(lists.select("pair"), "pair", "left_semi"), "postings")
    stars = posted.join(lists, "pair").where("id <> leader").select(F.col("leader").alias("u"), F.col("id").alias("v")).distinct()
    candidates = materialise(agreeing(stars, reps, threshold), "candidates")
    sets = shingle_table(docs, candidates, shingle, id_col, text_col)
    links = materialise(confirm(candidates, sets, numerator), "links")

    def part(edges: DataFrame, name: str) -> DataFrame:
        return materialise(components(edges).toDF("id", name), name)

    cluster, comp = part(candidates, "cluster"), part(links, "component")
    # members of one cluster in different components
    placed = cluster.join(comp, "id", "left").select("id", "cluster", F.coalesce("component", "id").alias("part"))
    weights = reps.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    open_ = placed.join(weights, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), (8 * F.sum("n_shingles")).alias("bytes"), F.min("part").alias("a"), F.max("part").alias("b"))
    open_ = open_.where("a <> b").select("cluster", "n", "bytes")
    open_ = materialise(open_, "open")  # as above: a hot cluster can be split
    joining = materialise(joining_links(placed.join(open_, "cluster"), sets, numerator), "joining")
    # members of one list in different clusters
    listed = posted.join(lists.drop("leader"), "pair").join(cluster, "id", "left").select("pair", "id", "n", F.coalesce("cluster", "id").alias("part"))
    listed = materialise(listed, "listed")
    several = listed.groupBy("pair").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("pair")
    several = materialise(several, "several")  # both sides of the join are then plain exchanges that can be split
    rest = materialise(agreeing_in_lists(listed.join(several, "pair", "left_semi"), reps, threshold), "rest")
    more = confirm(rest, shingle_table(docs, rest, shingle, id_col, text_col), numerator) if not rest.isEmpty() else rest

    edges = links.union(joining).union(more).union(members.where("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v")))
    whole = components(edges)
    out = sigs.select("id", "n_shingles").join(whole.withColumnRenamed("node", "id"), "id", "left")
    return out.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, numerator: int = 80) -> DataFrame:
    """One document of each group stays (the smallest id), with all its columns; rows without an id stay."""
    return without_ids(docs, "doc_id", near_duplicates(docs, numerator=numerator).where("not kept").select("id"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), numerator=85, threshold=THRESHOLD)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
