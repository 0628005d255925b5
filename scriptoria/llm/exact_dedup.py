"""Exact dedup by a log-structured merge index (DataFrame operations only).

*Memtables*: each input split digests its rows and flushes them as a run sorted by digest.  *Compaction* merges all
runs and keeps one identifier a digest (the smallest or the largest) with the number of its rows; the merge is Spark's
aggregation, which combines the rows of a hot digest inside each run before they meet.  A digest of one row is
settled by that.  *Hits*, digests with several rows, set the bits of a fixed-size *filter*; it is consulted before runs or
texts are moved, so only rows that may belong to a hit are looked up.  Hits are verified
byte for byte: their normalised texts are regrouped with the text itself as part of the key, so equal bytes
and nothing else merge; map-side combining leaves a row a task for a hot text.

Defined results: a null text counts as empty; rows with a null id lose against any other id but are never
dropped, having no id to name them by;
repeated rows with one id form one group in which every row of that id is kept or dropped together; an empty
table gives no rows.  Only the id and text columns are read, so extra columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FILTER_WORDS, materialise, mixed, read_table, scratch_path, without_ids

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hit digests up to this number (about 8 MB) are broadcast for the verification read, beyond it they are joined by shuffle.
BROADCAST_HITS = 100_000


def normalised(text: Column) -> Column:
    """Lower-case A-Z only; null is empty.  Texts of ASCII alone take the faster built-in."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def flush_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Flush the input as sorted digest runs (one file a split) and return them: id, digest, n_bytes, check."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "runs")
    norm = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("t"))
    runs = norm.select("id", F.sha2(F.col("t").cast("binary"), 256).alias("digest"), F.octet_length("t").cast("long").alias("n_bytes"), F.xxhash64("t").alias("check"))
    runs.sortWithinPartitions("digest", "id").write.mode("append").parquet(path)
    return spark.read.schema(runs.schema).parquet(path)


def _cell(digest: str) -> list[Column]:
    """Word and bit of a digest in the filter."""
    h = mixed(F.col(digest))
    return [(h % FILTER_WORDS).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftright(h, 40) % 64).cast("int")).alias("b")]


def hit_filter(hits: DataFrame) -> DataFrame:
    """(w, bits): the words of a filter over the hits' digests; at most ``FILTER_WORDS`` rows, whatever the number of hits."""
    return materialise(hits.select(*_cell("digest")).groupBy("w").agg(F.bit_or("b").alias("bits")), "filter")


def may_hit(rows: DataFrame, filt: DataFrame) -> DataFrame:
    """Rows (with a column digest) that the filter does not rule out; a full filter lets all pass."""
    probed = rows.select("*", *_cell("digest")).join(F.broadcast(filt), "w")
    return probed.where(F.col("b").bitwiseAND(F.col("bits")) != 0).select(*rows.columns)


def compact(runs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Merge runs: one row a digest with the identifier kept and the number of rows."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    return runs.groupBy("digest", "n_bytes", "check").agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def verify_hits(docs: DataFrame, hits: DataFrame, filt: DataFrame, keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Regroup the rows of hit digests by their bytes; two texts under one key would be an error, never a merge."""
    norm = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("t"))
    keyed = norm.withColumn("digest", F.sha2(F.col("t").cast("binary"), 256))
    keyed = may_hit(keyed, filt)
    small = hits.limit(BROADCAST_HITS + 1).count() <= BROADCAST_HITS
    wanted = hits.select("digest")
    found = keyed.join(F.broadcast(wanted) if small else wanted, "digest", "left_semi")
    pick = {"smallest": F.min, "largest": F.max}[keep]
    by_bytes = found.groupBy("digest", "t").agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    one = by_bytes.select("digest", F.xxhash64("t").alias("check"), F.octet_length("t").cast("long").alias("n_bytes"), "keep_id", "group_size")
    return one.groupBy("digest", "n_bytes", "check").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share a SHA-256 digest"))).cast("string").alias("clash"),
    )


def exact_groups(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest."""
    runs = flush_runs(docs, id_col, text_col)
    index = materialise(compact(runs, keep), "index")
    hits = index.where("group_size > 1")
    filt = hit_filter(hits)
    checked = materialise(verify_hits(docs, hits, filt, keep, id_col, text_col), "verified").drop("clash")
    alone = index.where("group_size = 1").select(F.col("keep_id").alias("id"), "keep_id", "group_size", F.lit(True).alias("kept"), "digest")
    found = may_hit(runs, filt).join(checked, ["digest", "n_bytes", "check"])
    return alone.unionByName(found.select("id", "keep_id", "group_size", (F.col("id").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"), "digest"))


def drop_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text, one stays."""
    groups = materialise(exact_groups(docs, keep, id_col, text_col), "groups")
    repeated = groups.where("kept and group_size > 1 and id is not null").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        docs = docs.dropDuplicates([id_col, text_col])
    return without_ids(docs, id_col, groups.where("not kept").select("id"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"), keep="largest").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


_NORM = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
OP2_SQL = f"""
WITH n AS (SELECT doc_id, sha256({_NORM}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM n"""
