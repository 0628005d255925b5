"""Near-duplicate vectors by tile products of int8 codes with rigorous error bounds.

A vector of length one is coded as ``scale * code`` with int8 components; the norms of the decoded vector and of what the code
leaves out are kept with it.  For two vectors the cosine then differs from the product of the decoded ones by at most
``|a| * |f| + |e| * |b| + |e| * |f|`` (a, b decoded, e, f left out), so a pair is certainly linked, certainly not linked, or open.
Equal vectors form a class, and one representative each is dealt into tiles near a pivot; two tiles whose centres and radii
exclude any link are never multiplied, all others are, each pair of tiles in a task of its own, codes only.
Of the open pairs only the rows that take part in one go on: they are joined with their full vectors, and the open pairs among
them are computed in double precision, again tile by tile.  Tasks return link counts by class and forests that join
what links join: a group of n copies or near copies never becomes n * n rows.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do rows without an id
(their component is null); vectors of different lengths have no cosine and do not link; rows that repeat an id are vectors of their own,
each with its own number of links, in one component; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table, shuffle_width
from .components import components
from .vectors import matrices, packed_rows

THRESHOLD = 0.9
#: Vectors of a tile, about; and most pivots (a sample of representatives by hash, of this size at any number of vectors).
TILE, PIVOTS = 4096, 256
#: Tiles whose centres are broadcast (8 bytes a component each); beyond, no pair of tiles is left out.
CENTRES = 20_000
#: Room for rounding of double sums: bounds closer than this to the threshold leave a pair open.
FUZZ = 1e-9
CODED = "id long, digest binary, dim int, code binary, scale double, inner double, outer double, pivot int"


def scaled_rows(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that are not zero, scaled by powers of two (so nothing overflows and no bit is lost), their norms, and which they are."""
    top = np.abs(m).max(axis=1)
    fine = top > 0
    m = np.ldexp(m[fine], -np.frexp(top[fine])[1][:, None])
    return m, np.sqrt((m * m).sum(axis=1)), fine


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors, norms of what they leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    back = code * scale[:, None]
    return code, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((unit - back) ** 2).sum(axis=1))


def coded(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``CODED`` columns without the pivot; the digest is null where a vector links with nothing."""

    def scan(batches):
        for batch in batches:
            n = batch.num_rows
            digest, dim, code = [None] * n, [None] * n, [None] * n
            scale, inner, outer = np.zeros(n), np.zeros(n), np.zeros(n)
            for at, m in matrices(batch.column(1)):
                m = m + 0.0  # no negative zeros
                scaled, norm, fine = scaled_rows(m)
                if not len(scaled):
                    continue
                raw, at = packed_rows(m[fine]), at[fine]
                codes, scale[at], inner[at], outer[at] = quantise(scaled / norm[:, None])
                for i, own, c in zip(at.tolist(), raw, packed_rows(codes), strict=True):
                    digest[i], dim[i], code[i] = hashlib.blake2b(own, digest_size=16).digest(), codes.shape[1], c
            columns = [batch.column(0), pa.array(digest, pa.binary()), pa.array(dim, pa.int32()), pa.array(code, pa.binary()), pa.array(scale), pa.array(inner), pa.array(outer)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "dim", "code", "scale", "inner", "outer"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(scan, CODED.rsplit(",", 1)[0])


def near_pivots(reps: DataFrame, pivots: int) -> DataFrame:
    """``reps`` with the nearest of a bounded sample of pivots of its own length (0 if that has none)."""
    sample = reps.select("dim", "code").orderBy(F.xxhash64("digest"), "digest").limit(pivots).collect()
    by_dim: dict[int, list[bytes]] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(bytes(r["code"]))
    held = reps.sparkSession.sparkContext.broadcast(by_dim)

    def place(batches):
        known = {d: _directions(np.frombuffer(b"".join(x), np.int8).reshape(-1, d)) for d, x in held.value.items()}
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            codes = batch.column("code").to_pylist()
            pivot = np.zeros(len(dim), np.int32)
            for d in np.unique(dim).tolist():
                if d in known:
                    at = np.flatnonzero(dim == d)
                    m = np.frombuffer(b"".join(codes[i] for i in at.tolist()), np.int8).reshape(-1, d).astype(np.float32)
                    pivot[at] = (m @ known[d].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=[*batch.schema.names, "pivot"])

    kept = ["id", "digest", "dim", "code", "scale", "inner", "outer", "copies"]
    return reps.select(*kept).mapInArrow(place, "id long, digest binary, dim int, code binary, scale double, inner double, outer double, copies long, pivot int")


def _directions(codes: np.ndarray) -> np.ndarray:
    m = codes.astype(np.float32)
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def tiled(placed: DataFrame, tile: int) -> DataFrame:
    """``placed`` with its tile (numbered from 0 within the vectors of one length) and the number of tiles of that length.

    The vectors of a pivot are dealt over as many tiles as they need, so that a hot pivot is no larger a tile than others."""
    counts = placed.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    # a row a pivot: of each length PIVOTS rows at most meet here
    numbered = materialise(counts, "pivots").selectExpr("dim", "pivot", "parts", "cast(sum(parts) over (partition by dim order by pivot) - parts as int) AS first", "cast(sum(parts) over (partition by dim) as int) AS tiles")
    rows = placed.join(materialise(numbered, "tile-numbers"), ["dim", "pivot"])
    return rows.withColumn("t", (F.col("first") + F.pmod(F.xxhash64("digest"), F.col("parts").cast("long"))).cast("int"))


TILES = "dim int, t int, tiles int, n int, ids binary, digests binary, copies binary, codes binary, scales binary, inner binary, outer binary, centre binary, radius double"


def packed_tiles(rows: DataFrame) -> DataFrame:
    """One row a tile: packed columns of its vectors, the centre of the decoded ones and the greatest distance from it."""

    def pack(batches):
        def done(key, held):
            ids, digests, copies, codes, scale, inner, outer = (list(x) for x in zip(*held, strict=True))
            scale = np.array(scale)
            own = np.frombuffer(b"".join(codes), np.int8).reshape(len(held), -1)
            back = own * scale[:, None]
            centre = back.mean(axis=0)
            radius = float((np.sqrt(((back - centre) ** 2).sum(axis=1)) + np.array(outer)).max())
            values = [*key, len(held), np.array(ids, np.int64).tobytes(), b"".join(digests), np.array(copies, np.int64).tobytes(), own.tobytes(), scale.tobytes(), np.array(inner).tobytes(), np.array(outer).tobytes(), centre.tobytes(), radius]
            kinds = [pa.int32()] * 4 + [pa.binary()] * 8 + [pa.float64()]
            names = [x.split()[0] for x in TILES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        key, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if held:
                        yield done(key, held)
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield done(key, held)

    width = shuffle_width(rows.sparkSession)
    dealt = rows.select("dim", "t", "tiles", "id", "digest", "copies", "code", "scale", "inner", "outer").repartition(width, "dim", "t").sortWithinPartitions("dim", "t")
    return materialise(dealt.mapInArrow(pack, TILES), "tiles")


def units(tiles: DataFrame, threshold: float) -> DataFrame:
    """Each tile under the pairs (a, b) of tiles that it is in, a <= b, without the pairs that hold no link.

    For x in one tile and y in another, x . y <= c . d + |c| * s + r * |d| + r * s (c, d centres, r, s radii)."""
    n = tiles.limit(CENTRES + 1).count()
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    if n <= CENTRES:
        found: dict[int, dict[int, tuple[bytes, float]]] = {}
        for r in tiles.select("dim", "t", "centre", "radius").collect():
            found.setdefault(r["dim"], {})[r["t"]] = (bytes(r["centre"]), r["radius"])
        held = tiles.sparkSession.sparkContext.broadcast(found)

        @F.udf("array<int>")  # one call a tile
        def partners(dim, t):
            own = held.value[dim]
            names = sorted(own)
            centres = np.frombuffer(b"".join(own[x][0] for x in names)).reshape(len(names), -1)
            radii = np.array([own[x][1] for x in names])
            c, r = np.frombuffer(own[t][0]), own[t][1]
            most = centres @ c + np.linalg.norm(c) * radii + r * np.linalg.norm(centres, axis=1) + r * radii
            return [x for x, m in zip(names, most.tolist(), strict=True) if m >= threshold - FUZZ or x == t]

        every = partners("dim", "t")
    dealt = tiles.withColumn("c", F.explode(every)).select("dim", F.least("t", "c").alias("a"), F.greatest("t", "c").alias("b"), *[c for c in tiles.columns if c not in ("dim", "tiles", "centre", "radius")])
    width = max(shuffle_width(tiles.sparkSession), min(10_000, n))
    return dealt.repartition(width, "dim", "a", "b").sortWithinPartitions("dim", "a", "b", "t")


class _Tile:
    def __init__(self, row, at: int):
        names = ["t", "n", "ids", "digests", "copies", "codes", "scales", "inner", "outer"]
        self.t, n, ids, self.digests, copies, codes, scale, inner, outer = (row[at + k] for k in range(len(names)))
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.codes = np.frombuffer(codes, np.int8).reshape(n, -1)
        self.scale, self.inner, self.outer = np.frombuffer(scale), np.frombuffer(inner), np.frombuffer(outer)


def code_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, in floats: sums of 1,024 products stay below 2**24."""
    if x.shape[1] <= 1024:
        return x.astype(np.float32) @ y.astype(np.float32).T
    return sum(x[:, lo : lo + 1024].astype(np.float32).astype(np.float64) @ y[:, lo : lo + 1024].astype(np.float64).T for lo in range(0, x.shape[1], 1024))


def bounded_pairs(p: _Tile, q: _Tile, threshold: float, same: bool, strip: int = 128):
    """(rows of p, rows of q, lower bound, upper bound of the cosine) of all pairs that can reach the threshold, strip by strip."""
    y = q.codes.astype(np.float32) if q.codes.shape[1] <= 1024 else q.codes
    top, most_outer, most_inner = q.scale.max(), q.outer.max(), q.inner.max()
    for lo in range(0, len(p.ids), strip):
        hi = min(lo + strip, len(p.ids))
        product = p.codes[lo:hi].astype(np.float32) @ y.T if y.dtype == np.float32 else code_products(p.codes[lo:hi], y)
        # first with the largest scale and error of the other tile
        slack = p.inner[lo:hi] * most_outer + p.outer[lo:hi] * (most_inner + most_outer)
        least = (threshold - FUZZ - slack) / (p.scale[lo:hi] * top)
        i, j = np.nonzero(product >= np.floor(least)[:, None])
        if same:
            i, j = i[j > i + lo], j[j > i + lo]
        value = product[i, j] * p.scale[lo + i] * q.scale[j]
        i = i + lo
        error = p.inner[i] * q.outer[j] + p.outer[i] * (q.inner[j] + q.outer[j]) + FUZZ
        may = value + error >= threshold
        yield i[may], j[may], (value - error)[may], (value + error)[may]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set of edges that joins what the edges (u, v) join: each node with the smallest node it reaches."""
    names, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(names))
    return names[label[away]], names[away]


class _Found:
    """Links of a task: numbers by class, and edges thinned to forests now and then."""

    def __init__(self):
        self.links: dict[bytes, int] = {}
        self.u, self.v, self.n = [], [], 0

    def add(self, p: _Tile, q: _Tile, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        for own, at, more in ((p, i, q.copies[j]), (q, j, p.copies[i])):
            sums = np.bincount(at, more, len(own.ids))
            for k in np.flatnonzero(sums).tolist():
                d = own.digests[16 * k : 16 * k + 16]
                self.links[d] = self.links.get(d, 0) + int(sums[k])
        self.u.append(p.ids[i])
        self.v.append(q.ids[j])
        self.n += len(i)
        if self.n > 200_000:
            self.thin()

    def thin(self) -> None:
        if self.n:
            u, v = forest(np.concatenate(self.u), np.concatenate(self.v))
            self.u, self.v, self.n = [u], [v], 0

    def batches(self, final: bool):
        """All there is at the end, or when it grows large."""
        if final or len(self.links) > 100_000 or sum(map(len, self.u)) > 400_000:
            self.thin()
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.u, self.v))
            k, e = len(self.links), len(u)
            if k + e:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*self.links, *[None] * e], pa.binary()), pa.array([*self.links.values(), *[None] * e], pa.int64()), pa.array([*[None] * k, *u.tolist()], pa.int64()), pa.array([*[None] * k, *v.tolist()], pa.int64()), pa.nulls(k + e, pa.int32()), pa.nulls(k + e, pa.int32()), pa.nulls(k + e, pa.int32()), pa.nulls(k + e, pa.int32())],
                    names=[x.split()[0] for x in FOUND.split(", ")])
            self.__init__()


#: What a unit returns: link counts (digest, links), edges (u, v), rows of open pairs (digest, dim, a, b, t).
FOUND = "digest binary, links long, u long, v long, dim int, a int, b int, t int"


def first_pass(dealt: DataFrame, threshold: float) -> DataFrame:
    """Certain links of all units, and the rows that take part in open pairs."""

    def scan(batches):
        found, key, held = _Found(), None, []

        def compare():
            if len(held) == 1 and key[1] != key[2]:  # the bounds of one of the two tiles, rounded the other way, exclude a link
                return
            p, q = held[0], held[-1]
            marks = [np.zeros(len(x.ids), bool) for x in (p, q)]
            for i, j, low, _ in bounded_pairs(p, q, threshold, len(held) == 1):
                sure = low >= threshold
                found.add(p, q, i[sure], j[sure])
                marks[0][i[~sure]] = True
                marks[1][j[~sure]] = True
            if len(held) == 1:
                marks = [marks[0] | marks[1]]
            for x, mark in zip(held, marks, strict=True):
                at = np.flatnonzero(mark).tolist()
                if at:
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.digests[16 * k : 16 * k + 16] for k in at], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *[pa.array([c] * n, pa.int32()) for c in (*key, x.t)]],
                        names=[c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:3] != key:
                    if held:
                        yield from compare()
                        yield from found.batches(False)
                    key, held = row[:3], []
                held.append(_Tile(row, 3))
        if held:
            yield from compare()
        yield from found.batches(True)

    return dealt.mapInArrow(scan, FOUND)


def second_pass(open_rows: DataFrame, threshold: float) -> DataFrame:
    """Links among the open pairs of each unit, in double precision.  ``open_rows``: dim, a, b, t, id, digest, copies, v (doubles)."""

    def scan(batches):
        found, key, held = _Found(), None, []

        def tile(rows):
            ids, digests, copies, v = (list(x) for x in zip(*rows, strict=True))
            out = object.__new__(_Tile)
            out.ids, out.digests, out.copies = np.array(ids, np.int64), b"".join(digests), np.array(copies, np.int64)
            out.full, out.norm, _ = scaled_rows(np.array(v, np.float64))
            out.codes, out.scale, out.inner, out.outer = quantise(out.full / out.norm[:, None])
            return out

        def compare():
            a, b = key[1:]
            p = tile([r[1:] for r in held if r[0] == a])
            q = p if a == b else tile([r[1:] for r in held if r[0] == b])
            for i, j, low, _ in bounded_pairs(p, q, threshold, a == b):
                i, j = i[low < threshold], j[low < threshold]
                for lo in range(0, len(i), 8192):
                    x, y = i[lo : lo + 8192], j[lo : lo + 8192]
                    linked = (p.full[x] * q.full[y]).sum(axis=1) / (p.norm[x] * q.norm[y]) >= threshold
                    found.add(p, q, x[linked], y[linked])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if held:
                        compare()
                        yield from found.batches(False)
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            compare()
        yield from found.batches(True)

    dealt = open_rows.select("dim", "a", "b", "t", "id", "digest", "copies", "v").repartition(shuffle_width(open_rows.sparkSession), "dim", "a", "b").sortWithinPartitions("dim", "a", "b")
    return dealt.mapInArrow(scan, FOUND)


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.  ``threshold`` is the least cosine, above 0."""
    every = materialise(coded(rows, id_col, vector_col), "coded")
    valid = every.where("digest is not null and id is not null")
    classes = materialise(valid.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    reps = valid.join(classes.select("digest", F.col("rep").alias("id"), "copies"), ["id", "digest"]).dropDuplicates(["digest"])
    reps = materialise(reps, "vector-reps")
    pivots = max(1, min(PIVOTS, reps.count() // (2 * tile)))
    tiles = packed_tiles(tiled(near_pivots(reps, pivots), tile))
    first = materialise(first_pass(units(tiles, threshold), threshold), "first-pass")

    open_ = first.where("t is not null").select("digest", "dim", "a", "b", "t")
    vectors = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    wanted = materialise(open_.select("digest").distinct().join(reps.select("digest", "id", "copies"), "digest"), "open-reps")
    # an id that repeats has several vectors: the digest tells them apart
    carried = materialise(with_digest(vectors.join(wanted.select("id").distinct(), "id", "left_semi")).join(wanted, ["id", "digest"]).dropDuplicates(["digest"]), "open-vectors")
    second = materialise(second_pass(open_.join(carried, "digest"), threshold), "second-pass")

    found = first.select("digest", "links", "u", "v").union(second.select("digest", "links", "u", "v"))
    linked = found.where("links is not null").groupBy("digest").agg(F.sum("links").alias("links"))
    totals = materialise(classes.join(linked, "digest", "left").select("digest", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "link-counts")
    members = every.select("id", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(totals, "digest", "left")
    members = materialise(members.select("id", "rep", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "vector-members")
    edges = found.where("u is not null").select("u", "v").union(members.where("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v")))
    whole = components(edges).withColumnRenamed("node", "id")
    out = members.join(whole, "id", "left").select("id", "n_links", F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def with_digest(vectors: DataFrame) -> DataFrame:
    """(id, v) with the digest that ``coded`` gives."""

    def scan(batches):
        for batch in batches:
            digest = [None] * batch.num_rows
            for at, m in matrices(batch.column(1)):
                for i, own in zip(at.tolist(), packed_rows(m + 0.0), strict=True):
                    digest[i] = hashlib.blake2b(own, digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest, pa.binary())], names=["id", "v", "digest"])

    return vectors.mapInArrow(scan, "id long, v array<double>, digest binary")


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


OP11_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, coalesce(least(e.vec_id, l.m), e.vec_id) AS component_id, e.vec_id = coalesce(least(e.vec_id, l.m), e.vec_id) AS kept
FROM embeddings e LEFT JOIN low l ON l.a = e.vec_id LEFT JOIN links k ON k.a = e.vec_id
"""
