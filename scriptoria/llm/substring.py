"""Substring dedup over Rabin-Karp hashes of every fixed-length token window.

A first scan finds the windows that can repeat at all: each window is marked by the least of the hashes of its
short grams, equal windows have equal marks, and marks that occur in one document only (proven by a fixed-size
filter) rule their windows out.  The Rabin-Karp hashes of all other windows are counted in Spark, keeping the smallest
document of each; a window whose smallest document is another, smaller one is to be removed.  Positions of
removed windows merge into maximal intervals, and texts are rewritten.  Hot windows are combined before the
shuffle when counted and split by the adaptive skew join when looked up.

Window hashes have 128 bits, two Rabin-Karp hashes over words hashed with bases of their own: among n windows that pass
the first scan a wrong match is expected n**2 / 2**129 times (about 1e-13 for 1e13 windows).

Defined results: null text has no words; rows with a null id have no place in the order: nothing is removed from
them or on their account; rows that repeat an id are separate texts, none of which counts as smaller than another.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import SECOND, SECOND_WORDS, gram_hashes, mix, sliding_min, text_chunks, word_hashes, words
from .common import materialise, read_table
from .removal import apply_spans, with_row_key
from .sieve import marked, repeat_filter

WINDOW, GRAM = 13, 6


def _windows(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Word hashes; for each window that lies in one document its start word, document and mark; first words."""
    starts, ends, first = words(data, offsets)
    if len(starts) < window:
        return None
    hashes = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
    mark = sliding_min(gram_hashes(hashes, gram), window - gram + 1)[at]
    # minima crowd at the low end: mixed again, they spread evenly over the filter
    return hashes, at, doc[at], mix(mark), first, (starts, ends)


def repeated_windows(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, span): word intervals to remove, from rows of id, t, key."""

    def marks(batch):
        base = 0
        for lo, hi, data, offsets in text_chunks(batch.column(0)):
            if found := _windows(data, offsets, window, gram):
                _, _, doc, mark, _, _ = found
                new = np.ones(len(mark), bool)
                new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
                yield mark[new], doc[new] + base
            base += hi - lo

    numbered = rows.where("id is not null and t is not null")
    held = rows.sparkSession.sparkContext.broadcast(repeat_filter(numbered, ["t"], marks))

    def emit(batches):
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for lo, _, data, offsets in text_chunks(batch.column(1)):
                if found := _windows(data, offsets, window, gram):
                    hashes, at, doc, mark, first, bounds = found
                    may = marked(held.value, mark)
                    at, doc = at[may], doc[may]
                    if not len(at):
                        continue
                    h = gram_hashes(hashes, window)[at]
                    g = gram_hashes(word_hashes(data, *bounds, SECOND), window, SECOND_WORDS)[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.astype(np.int64)), pa.array(g.astype(np.int64)), pa.array(ids[lo + doc]), pa.array(keys[lo + doc]), pa.array((at - first[doc]).astype(np.int32))],
                        names=["h", "g", "id", "key", "pos"])

    found = numbered.select("id", "t", "key").mapInArrow(emit, "h long, g long, id long, key long, pos int")
    counted = found.select("h", "g", "id").groupBy("h", "g").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # written: both sides of the look-up are then plain exchanges, and a hot window's rows can be split over tasks
    first = materialise(counted.where("first < last").select("h", "g", "first"), "repeated")
    same_key = rows.schema["key"].name == "key" and rows.select("key", "id").where("key <> id").isEmpty()
    slim = found.drop("key").withColumn("key", F.col("id")) if same_key else found
    hits = slim.join(first, ["h", "g"]).where("id > first").groupBy("key").agg(F.collect_set("pos").alias("pos"))

    def spans(batches):
        for batch in batches:
            out = []
            for p in batch.column(1):
                at = np.sort(np.array(p.values.to_numpy(), np.int64))
                out.append(np.column_stack([at, at + window]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "span"])

    return hits.mapInArrow(spans, "key long, span binary")


def _finish(text: bytes, spans: np.ndarray | None) -> tuple:
    found = text.split()
    n = len(found)
    if spans is not None:
        left, at = [], 0
        for lo, hi in spans.tolist():
            left += found[at:lo]
            at = hi
        found = left + found[at:]
    kept = b" ".join(found)
    return n, n - len(found), kept.decode(), hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept text and its digest."""
    rows = with_row_key(docs, id_col, text_col)
    return apply_spans(rows, repeated_windows(rows, window), _finish, "n_words long, n_removed long, kept string, kept_sha256 string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP3_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s : s + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM w)),
first AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN first USING (k) WHERE doc_id > first),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
left_ AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ ON w.doc_id = left_.doc_id"""
