"""A written inverted index: one row a term and document, with the document's places of that term.

``postings`` lies in folders of the term's bucket (a checksum of the term) and the document's block (a facet such as the year, or a hash of the key), each file sorted by term
and key, so that a query opens the folders of its terms and of the blocks it may meet, and in them the row groups of its terms.  A place
is ``4 * position + weight class`` (D to A as 0 to 3); places ascend, and Parquet stores them as differences (DELTA_BINARY_PACKED).
``terms`` has the number of documents and places of every term.  Both are tables like any other: nothing stays in memory between queries.

A query is one pass over the rows of its terms: they meet by document, the clauses are tested on the places, and the score is the cover
density: over all minimal covers (shortest stretches of the document that hold what the query asks for, from left to right), the mean weight of the cover's words,
harmonic, divided by one more than the number of other words in it.  Excluded words take no part in the score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions.stemming import stem
from scriptoria.operators import catalog
from scriptoria.operators import search as S

#: Folders of terms, of a large index and of a catalog's.
BUCKETS, CATALOG_BUCKETS = 64, 16
#: Slots of a block's bitmap of chosen documents, and most blocks that a query names in its filter.
SLOTS, NAMED_BLOCKS = 4096, 1000
CLASSES = "DCBA"


@dataclass(frozen=True)
class Index:
    """A written index, and how its words became terms."""

    path: str
    key: tuple[str, ...]
    config: S.Config = field(default=S.PLAIN)
    buckets: int = BUCKETS

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/postings")

    def terms(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/terms")


def bucket_of(term: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term.encode()) % buckets


def hash_block(key: list[str], blocks: int = 4) -> Column:
    """Block of a document without a facet to go by."""
    return F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("string")


def _slot(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS))


def _grouped(prepared: DataFrame, key: list[str], classes: list[int], config: S.Config) -> DataFrame:
    """One row a term and document of (key, block, one array of words a field): key, block, term, places.  A batch's words
    are encoded once, stemmed once each, and ordered by document and term as numbers."""

    def group(batches):
        stop = set(config.stop)
        for batch in batches:
            n = batch.num_rows
            rows, words, places, offset = [], [], [], np.zeros(n, np.int64)
            for k, w in enumerate(classes):
                column = batch.column(len(key) + 1 + k)
                edges = column.offsets.to_numpy().astype(np.int64)
                size = np.diff(edges)
                row = np.repeat(np.arange(n), size)
                rows.append(row)
                words.append(column.values.slice(edges[0], edges[-1] - edges[0]))
                places.append(4 * (np.arange(edges[0], edges[-1]) - edges[row] + 1 + offset[row]) + w)
                offset += size
            row, place = np.concatenate(rows), np.concatenate(places).astype(np.int32)
            encoded = pa.chunked_array(words, pa.string()).combine_chunks().dictionary_encode() if len(row) else None
            if encoded is None or not len(encoded):
                continue
            if isinstance(encoded, pa.ChunkedArray):
                encoded = encoded.combine_chunks()
            terms = [None if t in stop else stem(t) if config.stemmed else t for t in encoded.dictionary.to_pylist()]
            number = {t: k for k, t in enumerate(dict.fromkeys(t for t in terms if t))}
            names = pa.array(list(number), pa.string())
            code = np.array([number.get(t, -1) for t in terms])[encoded.indices.to_numpy()]
            kept = code >= 0
            row, place, code = row[kept], place[kept], code[kept]
            if not len(row):
                continue
            both = row * len(names) + code
            order = np.argsort(both, kind="stable")
            both, place = both[order], place[order]
            first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(both)).astype(np.int32)), pa.array(place))
            at = pa.array(both[first] // len(names))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(key) + 1)), names.take(pa.array(both[first] % len(names))), lists], names=[*key, "block", "term", "places"])

    types = dict(prepared.dtypes)
    return prepared.mapInArrow(group, ", ".join(f"`{c}` {types[c]}" for c in [*key, "block"]) + ", term string, places array<int>")


def write_index(docs: DataFrame, key: list[str], fields: list[tuple[str, str]], path: str, config: S.Config = S.PLAIN, block: Column | None = None, buckets: int = BUCKETS) -> Index:
    """Write the index of ``docs`` below ``path`` (a new folder): fields as (column, weight class) in the order of their positions.

    ``key`` is a key of ``docs``.  ``block`` is an expression over its columns; a null block is a block of its own.
    """
    shown = F.coalesce((hash_block(key) if block is None else block).cast("string"), F.lit("-")).alias("block")
    prepared = docs.select(*key, shown, *[S.tokens(F.col(c)).alias(f"_f{i}") for i, (c, _) in enumerate(fields)])
    rows = _grouped(prepared, key, [CLASSES.index(w) for _, w in fields], config).withColumn("bucket", F.pmod(F.crc32("term"), F.lit(buckets)).cast("int"))
    # a hot bucket is dealt over several tasks by its keys
    spread = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    dealt = rows.repartition("bucket", "block", F.pmod(F.xxhash64(*key), F.lit(spread)))
    packed = {"parquet.writer.version": "v2", "parquet.enable.dictionary#places.list.element": "false"}
    dealt.sortWithinPartitions("bucket", "block", "term", *key).write.options(**packed).partitionBy("bucket", "block").parquet(f"{path}/postings")
    index = Index(path, tuple(key), config, buckets)
    counts = index.postings(docs.sparkSession).groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size("places")).alias("places"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
    return index


def rows_of(index: Index, spark: SparkSession, terms: list[str], chosen: DataFrame | None = None) -> DataFrame:
    """Posting rows of some terms; with ``chosen`` (key columns and ``block``), of documents that may be among these.

    Blocks without a chosen document are not opened; in the others a bitmap of each block's chosen documents is tested before rows
    move.  The bitmaps' size follows the number of blocks, not of documents; they let some other documents pass."""
    rows = index.postings(spark).where(F.col("bucket").isin(*sorted({bucket_of(t, index.buckets) for t in terms})) & F.col("term").isin(*terms))
    rows = rows.withColumn("block", F.col("block").cast("string"))
    if chosen is None:
        return rows
    key = list(index.key)
    blocks = [r[0] for r in chosen.select("block").distinct().limit(NAMED_BLOCKS + 1).collect()]
    if len(blocks) <= NAMED_BLOCKS:
        if not blocks:
            return rows.where("false")
        rows = rows.where(F.col("block").isin(*blocks))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("_slot"), F.lit(64)).cast("int"))
    words = chosen.select("block", _slot(key).alias("_slot")).select("block", F.floor(F.col("_slot") / 64).alias("_w"), bit.alias("_b"))
    words = words.groupBy("block", "_w").agg(F.bit_or("_b").alias("_bits"))
    probed = rows.withColumn("_slot", _slot(key)).withColumns({"_w": F.floor(F.col("_slot") / 64), "_b": bit})
    small = len(blocks) <= NAMED_BLOCKS  # at most NAMED_BLOCKS * SLOTS / 64 words
    met = probed.join(F.broadcast(words) if small else words, ["block", "_w"])
    return met.where(F.col("_b").bitwiseAND(F.col("_bits")) != 0).select(*rows.columns)


Alternative = list[tuple[list[tuple[int, str]], bool]]


def alternatives(query: str, config: S.Config) -> list[Alternative]:
    """Clauses of each alternative as terms with their places; clauses of stop words alone are left out."""
    kept = [[(t, c.negated) for c in clauses if (t := S._terms(c, config))] for clauses in S.parse(query)]
    return [a for a in kept if a]


def _each(places: Column, f) -> Column:
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), f)


def _starting(place: int):
    """Where a phrase starts whose word at ``place`` has the place p."""
    return lambda p: F.shiftright(p, 2) - place


def _holds(m: Column, terms: list[tuple[int, str]]) -> Column:
    """Whether a document has the terms at places that agree."""
    if len(terms) == 1:
        return m[terms[0][1]].isNotNull()
    starts = None
    for place, term in terms:
        own = _each(m[term], _starting(place))
        starts = own if starts is None else F.array_intersect(starts, own)
    return F.size(starts) > 0


def _matches(m: Column, asked: list[Alternative]) -> Column:
    out = F.lit(False)
    for clauses in asked:
        every = F.lit(True)
        for terms, negated in clauses:
            every = every & (~_holds(m, terms) if negated else _holds(m, terms))
        out = out | every
    return out


def _asked_terms(asked: list[Alternative]) -> tuple[list[list[int]], list[list[tuple[int, int]]], list[str]]:
    """Positive clauses of each alternative as numbers of clauses; the clauses as (place, number of term); the terms."""
    wanted = [[tuple(t) for t, negated in clauses if not negated] for clauses in asked]
    clauses = list(dict.fromkeys(c for a in wanted for c in a))
    names = list(dict.fromkeys(t for c in clauses for _, t in c))
    return [[clauses.index(c) for c in a] for a in wanted if a], [[(p, names.index(t)) for p, t in c] for c in clauses], names


def cover_density(found: DataFrame, key: list[str], asked: list[Alternative]) -> DataFrame:
    """(key, score) of documents (key, m: places by term).

    One sweep over the merged places of a batch of documents: for each clause the start of its last occurrence so far; the alternative
    that is complete with the latest start gives the begin of the shortest stretch that ends here, and each begin counts
    once, where it is met first."""
    wanted, clauses, names = _asked_terms(asked)
    if not clauses:
        return found.select(*key, F.lit(0.0).alias("score"))
    inverse = np.array([1 / S.WEIGHTS[c] for c in CLASSES])

    def sweep(batches):
        for batch in batches:
            n = batch.num_rows
            rows, places, terms = [], [], []
            for k in range(len(names)):
                column = batch.column(len(key) + k)
                edges = column.offsets.to_numpy().astype(np.int64)
                rows.append(np.repeat(np.arange(n), np.diff(edges)))
                places.append(column.values.to_numpy()[edges[0] : edges[-1]].astype(np.int64))
                terms.append(np.full(edges[-1] - edges[0], k))
            row, place, term = (np.concatenate(x) for x in (rows, places, terms))
            order = np.lexsort((place, row))
            row, pos, term, cost = row[order], place[order] >> 2, term[order], inverse[place[order] & 3]
            before = np.append(0.0, np.cumsum(cost))
            e = np.arange(len(row))
            head = np.searchsorted(row, row)  # first entry of the same document
            last = []
            for own in clauses:
                m = len(own)
                met = e - (m - 1) >= head
                for back, (at, t) in enumerate(reversed(own)):
                    other = np.maximum(e - back, 0)
                    met &= (term[other] == t) & (pos - pos[other] == own[-1][0] - at)
                start = np.maximum.accumulate(np.where(met, e - (m - 1), -1)) if len(e) else e
                last.append(np.where(start >= head, start, -1))
            begin = np.max([np.min([last[c] for c in a], axis=0) for a in wanted], axis=0)
            cover = begin >= 0
            cover[1:] &= (row[1:] != row[:-1]) | (begin[1:] != begin[:-1])
            b, end = begin[cover], e[cover]
            words = end - b + 1
            gain = words / (before[end + 1] - before[b]) / (1 + pos[end] - pos[b] - (words - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(np.bincount(row[end], gain, n))], names=[*key, "score"])

    types = dict(found.dtypes)
    none = F.array().cast("array<int>")
    ready = found.select(*key, *[F.coalesce(F.col("m")[t], none).alias(f"_t{k}") for k, t in enumerate(names)])
    return ready.mapInArrow(sweep, ", ".join(f"`{c}` {types[c]}" for c in key) + ", score double")


def matching(index: Index, spark: SparkSession, query: str, universe: DataFrame | None = None, chosen: DataFrame | None = None, scored: bool = False) -> DataFrame:
    """Keys of the documents that match, with ``score`` if asked for.

    ``chosen`` (key columns and ``block``) restricts the documents before postings are read.  An alternative that only excludes needs the ``universe`` of keys
    (or ``chosen``); a query of stop words alone, or of nothing, matches nothing."""
    key = list(index.key)
    asked = alternatives(query, index.config)
    terms = sorted({t for a in asked for c, _ in a for _, t in c})
    rows = rows_of(index, spark, terms, chosen) if terms else index.postings(spark).where("false")
    # at most one row a term of the query meets for each document
    met = rows.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("m"))
    if any(all(negated for _, negated in a) for a in asked):
        every = universe if universe is not None else chosen
        if every is None:
            raise ValueError("a query that only excludes needs the universe of keys")
        met = every.select(*key).distinct().join(met, key, "left")
        met = met.withColumn("m", F.coalesce("m", F.create_map().cast("map<string,array<int>>")))
    elif chosen is not None:
        met = met.join(chosen.select(*key), key, "left_semi")
    found = met.where(_matches(F.col("m"), asked))
    return cover_density(found, key, asked) if scored else found.select(*key)


def weighted_counts(index: Index, spark: SparkSession, words: list[str]) -> DataFrame:
    """(key, score): the sum of the weights of all places of some words."""
    terms = sorted({t for w in words if (t := index.config.term(w)) is not None})
    weight = F.array(*[F.lit(S.WEIGHTS[c]) for c in CLASSES])
    own = F.aggregate("places", F.lit(0.0), lambda s, p: s + F.get(weight, F.pmod(p, F.lit(4))))
    return rows_of(index, spark, terms).groupBy(*index.key).agg(F.sum(own).alias("score"))


#: Fields of a document in the catalog's search, with their weights.
CATALOG_FIELDS = [("_author", "A"), ("_title", "A"), ("creationRaw", "B"), ("content", "C")]
CATALOG_KEY = ("slug", "position")


def catalog_index(documents: DataFrame, path: str, config: S.Config, block: Column) -> Index:
    """Write the index of the catalog's inner documents; ``block`` is the container's year."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    ready = documents.withColumns({"_author": F.concat_ws(" ", blank("authorName"), blank("authorRaw")), "_title": F.concat_ws(" ", blank("documentTitle"), blank("description"))})
    return write_index(ready, list(CATALOG_KEY), CATALOG_FIELDS, path, config, block, CATALOG_BUCKETS)


def facet_documents(containers: DataFrame, documents: DataFrame, filters: catalog.Filters) -> DataFrame:
    """Keys of the documents that the facets choose, each with the block that holds its postings."""
    chosen = catalog.where(containers, filters.container_predicate()).select("slug", F.col("siteYear").cast("string").alias("block"))
    return catalog.where(documents, filters.document_predicate()).select(*CATALOG_KEY).join(chosen, "slug").withColumn("block", F.coalesce("block", F.lit("-")))


def found_catalog(containers: DataFrame, documents: DataFrame, index: Index, filters: catalog.Filters) -> DataFrame:
    """The catalog under all filters, the text query among them: documents that match it, in the listing's order, each with its ``score``.

    Facets come first: they choose documents, and only postings of these are read and moved."""
    if not filters.q:
        return catalog.catalog(containers, documents, filters)
    facets = filters.siteYear is not None or filters.document_predicate() is not None
    chosen = facet_documents(containers, documents, filters) if facets else None
    hits = matching(index, containers.sparkSession, filters.q, documents, chosen, scored=True)
    return catalog.catalog(containers, documents.join(hits, list(CATALOG_KEY)), filters)


def ranked_documents(containers: DataFrame, documents: DataFrame, index: Index, filters: catalog.Filters) -> DataFrame:
    """Keys and scores of the matching documents, best first (ties by key): what a search lists before it is grouped by containers."""
    chosen = facet_documents(containers, documents, filters)
    return matching(index, containers.sparkSession, filters.q or "", documents, chosen, scored=True).orderBy(F.desc("score"), *CATALOG_KEY)
