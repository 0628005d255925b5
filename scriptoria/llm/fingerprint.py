"""Document fingerprints by a homomorphic multiset hash (DataFrame and SQL operations only).

Each paragraph (a line) is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors modulo powers of two: the order of paragraphs plays no part, and a paragraph is inserted or deleted by
adding or subtracting its vector (``combine``).  The vector has two parts:

* 8 exact lanes of 32 bits, the words of the paragraph's SHA-256, summed modulo 2**32: equal multisets of
  paragraphs have equal lanes, different ones do not but by a chance of about 2**-256;
* 128 likeness lanes of 32 bits, two to a long: for each three-word piece of the paragraph (or the whole
  paragraph if shorter) every lane gets one bit of its hash, summed modulo 2**32.  A text has fewer than 2**31
  pieces (that is Spark's longest string), so its sums neither wrap nor carry into the next lane.  A lane with c ones
  of n pieces has the signed sum 2c - n, so the dot product of two documents' lanes estimates the pieces that they share.

Likeness is that dot product over the larger squared norm, within 0 and 1; the error is about 0.09.

Defined results: null text is empty; empty texts have the zero fingerprint, likeness 1 to each other and 0 to other
texts; rows are ordered by id, then by a digest of the text; rows with a null id come first; in a table of one
row the next document is the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, shuffle_width

EXACT_LANES, LANE_BITS, PER_LONG = 8, 32, 2
#: Hashes of 64 bits a piece; each gives 32 longs of two one-bit lanes.
HASHES = 2
LONGS = HASHES * LANE_BITS
LANES = LONGS * PER_LONG
_MASK = sum(1 << (LANE_BITS * k) for k in range(PER_LONG))
_ONES = (1 << LANE_BITS) - 1


def _lane_hash(x: Column, k: int) -> Column:
    return x if k == 0 else F.xxhash64(x, F.lit(k))


def _lane_sums() -> list[Column]:
    """Likeness lanes: sums of one-bit lanes of the piece hashes x0, x1, ..."""
    return [F.sum(F.shiftrightunsigned(f"x{k}", j).bitwiseAND(F.lit(_MASK))).alias(f"l{k * LANE_BITS + j}") for k in range(HASHES) for j in range(LANE_BITS)]


def _exact_sums() -> list[Column]:
    """Exact lanes: sums of the words of the paragraphs' digests d, counted with each paragraph's first piece (i = 0)."""
    word = [F.conv(F.substring("d", 1 + 8 * e, 8), 16, 10).cast("long") for e in range(EXACT_LANES)]
    return [F.sum(F.when(F.col("i") == 0, x)).bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"e{e}") for e, x in enumerate(word)]


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Sum (or with sign -1 difference) of two fingerprint structs (n, exact, lanes), lane by lane modulo powers."""
    s = F.lit(sign).cast("long")

    def lane(x: Column, y: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(PER_LONG):
            one = (F.shiftrightunsigned(x, LANE_BITS * k).bitwiseAND(F.lit(_ONES)) + s * F.shiftrightunsigned(y, LANE_BITS * k).bitwiseAND(F.lit(_ONES))).bitwiseAND(F.lit(_ONES))
            out = out.bitwiseOR(F.shiftleft(one, LANE_BITS * k))
        return out

    return F.struct(
        (a["n"] + s * b["n"]).alias("n"),
        F.zip_with(a["exact"], b["exact"], lambda x, y: (x + s * y).bitwiseAND(F.lit(0xFFFFFFFF))).alias("exact"),
        F.zip_with(a["lanes"], b["lanes"], lane).alias("lanes"),
    )


def _dot(x: str, n: str, y: str, m: str) -> str:
    """SQL: dot product of the signed lanes of two fingerprints (n and m pieces)."""
    lane = " + ".join(
        f"cast(2 * (shiftrightunsigned(p.x, {LANE_BITS * k}) & {_ONES}) - {n} as double) * (2 * (shiftrightunsigned(p.y, {LANE_BITS * k}) & {_ONES}) - {m})"
        for k in range(PER_LONG)
    )
    return f"aggregate(arrays_zip({x} as x, {y} as y), 0D, (s, p) -> s + {lane})".replace(f"arrays_zip({x} as x, {y} as y)", f"zip_with({x}, {y}, (u, v) -> named_struct('x', u, 'y', v))")


def likeness(a: str, b: str) -> Column:
    """Likeness of two fingerprint columns (structs n, exact, lanes; null is the empty text's)."""
    dot = _dot(f"{a}.lanes", f"{a}.n", f"{b}.lanes", f"{b}.n")
    aa, bb = _dot(f"{a}.lanes", f"{a}.n", f"{a}.lanes", f"{a}.n"), _dot(f"{b}.lanes", f"{b}.n", f"{b}.lanes", f"{b}.n")
    value = f"least(1D, greatest(0D, {dot} / greatest({aa}, {bb})))"
    return F.expr(f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN 1D WHEN {a} IS NULL OR {b} IS NULL THEN 0D WHEN {a} = {b} THEN 1D ELSE {value} END")


def printed(a: str) -> Column:
    """A fingerprint as text: pieces, exact lanes and likeness lanes in hexadecimal."""
    exact = F.array_join(F.transform(F.col(f"{a}.exact"), lambda x: F.lpad(F.hex(x), 8, "0")), "")
    lanes = F.array_join(F.transform(F.col(f"{a}.lanes"), lambda x: F.hex(x)), ".")
    return F.when(F.col(a).isNull(), F.lit("0")).otherwise(F.lower(F.concat_ws(":", F.hex(F.col(f"{a}.n")), exact, lanes)))


def next_rows(keys: DataFrame) -> DataFrame:
    """For rows (key, o1, o2) ordered by (o1, o2): key and the key of the next row (after the last: the first).

    Rows are dealt by range and each range is ordered on its own; the last row of a range is followed by the first
    of the next one that has rows, found in a table with one row a range.
    """
    n = max(1, shuffle_width(keys.sparkSession))
    dealt = materialise(keys.repartitionByRange(n, "o1", "o2").withColumn("range", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("range").orderBy("o1", "o2", "key")
    inner = dealt.select("range", "key", F.lead("key").over(w).alias("next"))
    heads = dealt.groupBy("range").agg(F.min(F.struct(F.col("o1"), F.col("o2"), F.col("key"))).alias("head")).select("range", F.col("head.key").alias("head"))
    order = Window.orderBy("range")
    follow = heads.select("range", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("follow"))
    return inner.join(F.broadcast(follow), "range").select("key", F.coalesce("next", "follow").alias("next"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    repeated = not base.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").isEmpty()
    if repeated:  # rows get a key of their own and the digest of their text as second order
        base = materialise(base.withColumn("key", F.monotonically_increasing_id()).withColumn("o2", F.sha2("t", 256)), "keyed")
        ids = base.select("key", "id")
        order = base.select("key", F.col("id").alias("o1"), "o2")
    else:
        base = base.select(F.col("id").alias("key"), "t")
        ids, order = None, base.select("key", F.col("key").alias("o1"), F.lit("").alias("o2"))
    follows = materialise(next_rows(order), "next")
    # both uses of the texts have one shape, so one exchange serves them
    texts = base.where("key is not null").select("key", "t")
    sizes = base.where("key is not null").select(F.col("key").alias("previous"), F.floor(F.length("t") / 4).cast("int").alias("k"))
    asked = materialise(follows.withColumnsRenamed({"key": "previous", "next": "key"}).join(sizes, "previous").where("k > 0"), "asked")
    donors = texts.join(asked, "key").select(F.col("previous").alias("key"), F.expr("substring(t, 1, k)").alias("gift"))
    kept = F.expr("substring(t, 1, cast(length(t) - floor(length(t) / 4) as int))")
    both = texts.join(donors, "key", "left").select("key", F.col("t").alias("own"), F.concat(kept, F.coalesce("gift", F.lit(""))).alias("edited"))
    out = _compare(both, follows)
    return out.withColumnRenamed("key", "id") if ids is None else ids.join(out, "key").drop("key")


def _compare(texts: DataFrame, follows: DataFrame) -> DataFrame:
    """Fingerprints of both texts of a row in one hash aggregation over its pieces, then the likenesses."""
    both = texts.select("key", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("own").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("v"))
    rows = both.select("key", "v.kind", "v.t").withColumns({"n_chars": F.length("t").cast("long"), "sha": F.unhex(F.sha2(F.col("t").cast("binary"), 256))})
    lines = F.when(F.length("t") > 0, F.split("t", "\n")).otherwise(F.array(F.lit(None).cast("string")))
    # key, kind, size and digest are all grouping columns: sums alone are aggregated, so it stays a hash aggregation
    group = ["key", "kind", "n_chars", "sha"]
    paragraphs = rows.select(*group, F.explode(lines).alias("p"))
    pieces = paragraphs.select(*group, F.sha2(F.col("p").cast("binary"), 256).alias("d"), F.split("p", " ").alias("w"))
    exploded = pieces.select(*group, "d", F.posexplode_outer(F.expr(
        "CASE WHEN w IS NOT NULL THEN transform(sequence(0, greatest(size(w) - 3, 0)), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))) END")).alias("i", "x"))
    hashed = exploded.select(*group, "d", "i", *[F.when(F.col("x").isNotNull(), _lane_hash(F.col("x"), k)).alias(f"x{k}") for k in range(HASHES)])
    sums = hashed.groupBy(*group).agg(F.count("x0").alias("n"), *_exact_sums(), *_lane_sums())
    fp = F.when(F.col("n") > 0, F.struct("n", F.array(*[f"e{e}" for e in range(EXACT_LANES)]).alias("exact"), F.array(*[f"l{j}" for j in range(LONGS)]).alias("lanes")))
    pairs = sums.select("key", F.struct("kind", "n_chars", "sha", fp.alias("fp")).alias("v")).groupBy("key").agg(F.sort_array(F.collect_list("v")).alias("v"))
    own, edited = F.get("v", F.lit(0)), F.get("v", F.lit(1))
    prints = pairs.select("key", own["n_chars"].alias("n_chars"), edited["sha"].alias("sha"), own["fp"].alias("fp"), edited["fp"].alias("efp"))
    prints = materialise(prints.join(follows, "key"), "prints")
    joined = prints.join(prints.select(F.col("key").alias("next"), F.col("fp").alias("nfp")), "next")
    return joined.select(
        "key", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), printed("fp").alias("fingerprint"), printed("efp").alias("edited_fingerprint"),
        likeness("fp", "efp").alias("near_edited"), likeness("fp", "nfp").alias("near_next"),
    )


def op6_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
