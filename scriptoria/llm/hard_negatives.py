"""Hard negatives by bit-sliced integer products.

Components are integers (``floor(scale * x)``).  A block of rows is cut into bit planes, least value subtracted, and its products
with the anchors are summed plane by plane, the most significant first.  After a plane a score is known up to
``rest * sum(|anchor|)``, ``rest`` being what the lower planes can hold; this interval narrows with each plane, and a row goes as soon as it
cannot be among those asked for.  While many rows are left a plane is one matrix product; later only the rows left are summed.

*Positives*: an anchor's best rows of its own label.  *Negatives*: for each anchor and positive, the best rows of other labels whose
score lies in the positive's band.  Both run over pairs of an anchor block and a row block, each pair in a task of its own; each returns its own
best few, which are ranked once more.  Anchors are a stated share of the rows.

Defined results: rows without an id or label, and those whose vector is null or empty or holds null or non-finite components (or integers of 2**53 or more), take no part; two rows
whose score does not fit 64 bits are no pair; of rows that repeat an id the one with the least label, then the least vector, takes part; vectors of another length than the anchor's are no candidates; a tie goes to the smaller id; an anchor
without positives, and a positive without rows in its band, give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, shuffle_width
from .vectors import matrices, packed_rows

#: Rows of an anchor block and of a row block, about; anchors of a step of the search.
ANCHORS, ROWS, STRIP = 1024, 8192, 64
#: Once fewer than this share of the scores is open, only these are summed.
DENSE = 1 / 16


def integer_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """id, label, dim, v (packed 64-bit components ``floor(scale * x)``) of the rows that take part, one an id."""

    def scan(batches):
        for batch in batches:
            for at, m in matrices(batch.column(2)):
                v = np.floor(scale * m)
                fits = (np.abs(v) < 2.0**53).all(axis=1)
                at, v = at[fits], v[fits]
                own = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(np.full(len(at), m.shape[1], np.int32)), pa.array(packed_rows(v.astype("<i8")), pa.binary())], names=["id", "label", "dim", "v"])

    valid = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x")).where("id is not null and label is not null")
    found = valid.mapInArrow(scan, "id long, label long, dim int, v binary")
    return found.groupBy("id").agg(F.min(F.struct("label", "dim", "v")).alias("r")).select("id", "r.label", "r.dim", "r.v")


def bit_planes(rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Least value of each component, and (bit, 0/1 matrix) of what is above it, the most significant first."""
    base = rows.min(axis=0)
    above = (rows - base).astype(np.uint64)
    return base, [(b, ((above >> np.uint64(b)) & np.uint64(1)).astype(np.float64)) for b in reversed(range(int(above.max(initial=0)).bit_length()))]


#: Given anchors i, rows j and the least and greatest score that each may have: which of them can still be asked for.
Keep = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def narrowed(anchors: np.ndarray, base: np.ndarray, planes: list[tuple[int, np.ndarray]], live: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors i, rows j, exact scores) of the pairs, among those marked ``live``, that ``keep`` retains to the last plane."""
    a = anchors.astype(np.float64)
    plus, minus = np.maximum(a, 0).sum(axis=1), np.minimum(a, 0).sum(axis=1)
    largest = max(float(np.abs(base).max(initial=0)), 2.0 ** (planes[0][0] + 1) if planes else 1.0)
    if not len(a) or float(np.abs(a).sum(axis=1).max()) * largest >= 2.0**53:
        return exact(anchors, base, planes, live)
    i, j = np.nonzero(live)
    score = np.repeat(a @ base.astype(np.float64), live.sum(axis=1))
    for b, plane in planes:
        if len(i) > DENSE * live.size:
            score = score + 2.0**b * (a @ plane.T)[i, j]
        else:
            for lo in range(0, len(i), 1 << 16):
                at = slice(lo, lo + (1 << 16))
                score[at] += 2.0**b * np.einsum("nk,nk->n", a[i[at]], plane[j[at]])
        rest = 2.0**b - 1
        may = keep(i, j, score + rest * minus[i], score + rest * plus[i])
        i, j, score = i[may], j[may], score[may]
    return i, j, score.astype(np.int64)


def exact(anchors: np.ndarray, base: np.ndarray, planes: list[tuple[int, np.ndarray]], live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``narrowed`` for scores beyond the exact range of doubles: in Python's integers, nothing left out but what 64 bits cannot hold."""
    i, j = np.nonzero(live)
    rows = base[None, :].astype(object) + sum((plane.astype(np.int64).astype(object) << b for b, plane in planes), np.zeros((live.shape[1], len(base)), object))
    score = [sum(x * y for x, y in zip(anchors[p].tolist(), rows[q].tolist(), strict=True)) for p, q in zip(i.tolist(), j.tolist(), strict=True)]
    fits = np.array([abs(s) < 1 << 63 for s in score], bool)
    return i[fits], j[fits], np.array([s for s in score if abs(s) < 1 << 63], np.int64)


def kth_largest(group: np.ndarray, value: np.ndarray, k: int, groups: int) -> np.ndarray:
    """For each group the k-th largest of its values, -inf with fewer.  ``group`` is sorted."""
    out = np.full(groups, -np.inf)
    edges = np.searchsorted(group, np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(edges) >= k).tolist():
        own = value[edges[g] : edges[g + 1]]
        out[g] = np.partition(own, len(own) - k)[len(own) - k]
    return out


def best_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: by score, then by the smaller id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return order[rank < k]


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` (dim, ...) dealt into blocks of about ``size`` rows of one length, written: block and number of blocks of that length."""
    rows = materialise(rows, name)
    counts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    dealt = rows.join(materialise(counts, f"{name}-parts"), "dim")
    return dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int"))


UNIT = ["dim", "ab", "rb"]


def units(anchors: DataFrame, rows: DataFrame, extra: str) -> DataFrame:
    """Each anchor block with each row block of the same length: UNIT, kind (0 anchors, 1 rows), id, label, v and the anchors' column ``extra``."""
    a_parts = anchors.select("dim", F.col("parts").alias("other")).distinct()
    r_parts = rows.select("dim", F.col("parts").alias("other")).distinct()
    kind = anchors.schema[extra].dataType
    a = anchors.join(r_parts, "dim").select("dim", F.col("block").alias("ab"), F.explode(F.sequence(F.lit(0), F.col("other") - 1)).alias("rb"), F.lit(0).alias("kind"), "id", "label", "v", extra)
    r = rows.join(a_parts, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("other") - 1)).alias("ab"), F.col("block").alias("rb"), F.lit(1).alias("kind"), "id", "label", "v", F.lit(None).cast(kind).alias(extra))
    both = a.union(r)
    return both.repartition(shuffle_width(rows.sparkSession), *UNIT).sortWithinPartitions(*UNIT, "kind")


class _Rows:
    def __init__(self, rows: list[tuple]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.values = np.frombuffer(b"".join(r[2] for r in rows), "<i8").reshape(len(rows), -1)
        self.extra = [r[3] for r in rows]


def _by_unit(search: Callable[[_Rows, _Rows], Iterator[pa.RecordBatch]]):
    """Run ``search(anchors, rows)`` over the sorted units of a partition."""

    def scan(batches):
        key, held = None, ([], [])

        def done():
            if held[0] and held[1]:
                yield from search(_Rows(held[0]), _Rows(held[1]))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    yield from done()
                    key, held = row[:3], ([], [])
                held[row[3]].append(row[4:])
        yield from done()

    return scan


def hundredths(value: np.ndarray, share: int) -> np.ndarray:
    """floor(value * share / 100) without a product that overflows."""
    return value // 100 * share + value % 100 * share // 100


def positives(anchors: DataFrame, rows: DataFrame, count: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the best ``count`` rows of each anchor's own label."""

    def search(own: _Rows, other: _Rows):
        base, planes = bit_planes(other.values)
        for lo in range(0, len(own.ids), STRIP):
            part = slice(lo, lo + STRIP)
            n = len(own.ids[part])
            live = (own.labels[part, None] == other.labels[None, :]) & (own.ids[part, None] != other.ids[None, :])

            def keep(i, j, low, high, n=n):
                return high >= kth_largest(i, low, count, n)[i]

            i, j, score = narrowed(own.values[part], base, planes, live, keep)
            at = best_of(i, score, other.ids[j], count)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(own.ids[lo + i[at]]), pa.array(other.ids[j[at]]), pa.array(score[at])], names=["anchor_id", "positive_id", "positive_score"])

    found = units(anchors.withColumn("none", F.lit(None).cast("int")), rows, "none").mapInArrow(_by_unit(search), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= count).drop("k")


def negatives(anchors: DataFrame, rows: DataFrame, count: int, low_share: int, high_share: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score, rank) of the best ``count`` rows of other labels in each positive's band:
    low_share * positive <= 100 * negative <= high_share * positive.  ``anchors`` has an array ``wanted`` of its positives (positive_score, positive_id)."""
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def search(own: _Rows, other: _Rows):
        base, planes = bit_planes(other.values)
        for lo in range(0, len(own.ids), STRIP):
            n = len(own.ids[lo : lo + STRIP])
            wanted = [(k, s["positive_score"], s["positive_id"]) for k in range(n) for s in own.extra[lo + k]]
            who, want, pid = (np.array([w[c] for w in wanted], np.int64) for c in range(3))
            least, most = -hundredths(-want, low_share), hundredths(want, high_share)  # the band in whole scores: ceil and floor
            some = least <= most
            who, want, pid, least, most = who[some], want[some], pid[some], least[some], most[some]
            if not len(who):
                continue
            bottom, top = np.full(n, np.inf), np.full(n, -np.inf)
            np.minimum.at(bottom, who, least)
            np.maximum.at(top, who, most)
            edges = np.searchsorted(who, np.arange(n + 1))
            live = (own.labels[lo : lo + n, None] != other.labels[None, :]) & (top > -np.inf)[:, None]

            def keep(i, j, low, high):
                may = (high >= bottom[i]) & (low <= top[i])
                # a row is asked for by a positive while fewer than ``count`` rows are certain to be in its band and before it
                at = np.flatnonzero(may)
                if len(at) > DENSE * live.size:
                    return may
                p, q, low, high = i[at], at, low[at], high[at]
                still = np.zeros(len(may), bool)
                ends = np.searchsorted(p, np.arange(n + 1))
                for g in np.flatnonzero(np.diff(ends)).tolist():
                    own_low, own_high, own_at = (x[ends[g] : ends[g + 1]] for x in (low, high, q))
                    for w in range(edges[g], edges[g + 1]):
                        fits = (own_high >= least[w]) & (own_low <= most[w])
                        sure = own_low[(own_low >= least[w]) & (own_high <= most[w])]
                        if len(sure) >= count:
                            fits &= own_high >= np.partition(sure, len(sure) - count)[len(sure) - count]
                        still[own_at[fits]] = True
                return still

            i, j, score = narrowed(own.values[lo : lo + n], base, planes, live, keep)
            ends = np.searchsorted(i, np.arange(n + 1))
            out = []
            for w in range(len(who)):
                g = slice(ends[who[w]], ends[who[w] + 1])
                fits = np.flatnonzero((score[g] >= least[w]) & (score[g] <= most[w]))
                ids, own_score = other.ids[j[g][fits]], score[g][fits]
                for k in np.lexsort((ids, -own_score))[:count].tolist():
                    out.append((int(own.ids[lo + who[w]]), int(pid[w]), int(want[w]), int(ids[k]), int(own_score[k])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    found = units(anchors, rows, "wanted").mapInArrow(_by_unit(search), ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame, anchor: Column, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, positive_count: int = 5, negative_count: int = 3,
    low_share: int = 50, high_share: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on the column ``id``; ``label`` may compute the label from the input's columns.  Shares are hundredths of a positive's score."""
    vectors = integer_vectors(rows, scale, id_col, vector_col, F.col("label") if label is None else label)
    own = blocks(vectors, ROWS, "integer-vectors")
    anchors = blocks(own.where(anchor).select("id", "label", "dim", "v"), ANCHORS, "anchors")
    pos = materialise(positives(anchors, own, positive_count), "positives")
    wanted = pos.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_score", "positive_id")).alias("wanted"))  # positive_count at most
    with_wanted = materialise(anchors.join(wanted, "id"), "wanted")
    return negatives(with_wanted, own, negative_count, low_share, high_share).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, a.label AS al, b.vec_id AS b, b.label AS bl, list_dot_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT a, b, score FROM s WHERE al = bl QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND s.al <> s.bl WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 3
"""
