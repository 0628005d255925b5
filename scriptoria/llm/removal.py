"""Shared end of the two substring operators: take spans out of texts without moving the texts that have none."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_WORDS, key_filter_words, materialise, mixed


def with_row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t and key: the id itself, or a digest of id and text where ids repeat (so each text keeps its own spans)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    repeated = rows.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.withColumn("key", F.col("id") if repeated.isEmpty() else F.xxhash64("id", "t"))


def merge_spans(blobs: list[bytes]) -> np.ndarray:
    """Sorted disjoint [start, end) rows from packed (start, end) pairs; touching spans become one."""
    at = np.concatenate([np.frombuffer(b, np.int64) for b in blobs]).reshape(-1, 2)
    at = at[np.lexsort((at[:, 1], at[:, 0]))]
    end = np.maximum.accumulate(at[:, 1])
    new = np.ones(len(at), bool)
    new[1:] = at[1:, 0] > end[:-1]
    first = np.flatnonzero(new)
    return np.column_stack([at[first, 0], end[np.append(first[1:], len(at)) - 1]])


def apply_spans(rows: DataFrame, spans: DataFrame, finish: Callable[[bytes, np.ndarray | None], tuple], schema: str) -> DataFrame:
    """``finish(text, spans or None)`` for every row of ``rows`` (id, t, key).

    ``spans`` has (key, span): packed pairs of positions, any number of rows a key.  Rows that a fixed-size filter
    proves to have no spans are finished where they are read; the others are joined with their spans.
    """
    packed = materialise(spans.groupBy("key").agg(F.collect_list("span").alias("spans")), "spans")
    held = rows.sparkSession.sparkContext.broadcast(key_filter_words(packed, "key"))
    names = ["id", *(x.split()[0] for x in schema.split(","))]
    types = {"long": pa.int64(), "string": pa.string()}
    kinds = [types[x.split()[1]] for x in schema.split(",")]
    hashed = rows.withColumn("h", mixed(F.col("key")))

    def pick(batches, want: bool):
        for batch in batches:
            h = batch.column(3).to_numpy()
            may = (held.value[h % FILTER_WORDS] >> ((h >> 40) % 64)) & 1 == 1
            may &= ~np.asarray(batch.column(0).is_null())
            yield batch.filter(pa.array(may if want else ~may))

    def table(ids, out):
        columns = zip(*out, strict=True) if out else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([ids, *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=names)

    def plain(batches):
        for batch in pick(batches, False):
            yield table(batch.column(0), [finish((t.as_py() or "").encode(), None) for t in batch.column(1)])

    def chosen(batches):
        yield from (b.select([0, 1, 2]) for b in pick(batches, True))

    def cut(batches):
        for batch in batches:
            out = []
            for t, s in zip(batch.column(1), batch.column(2), strict=True):
                s = s.as_py()
                out.append(finish((t.as_py() or "").encode(), merge_spans(s) if s else None))
            yield table(batch.column(0), out)

    some = hashed.mapInArrow(chosen, "id long, t string, key long").join(packed, "key", "left").select("id", "t", "spans")
    return hashed.mapInArrow(plain, f"id long, {schema}").unionByName(some.mapInArrow(cut, f"id long, {schema}"))
