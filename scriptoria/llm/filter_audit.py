"""What each of five filters removes in every order, with exact duplicates found by partition refinement.

Duplicates: documents are split by code-point length, then by hashes of one block of the text after the other, and a class of one
document goes at each step (most go early; later steps see the others only).  Blocks grow in length, so that a text of n
code points has about log(n) of them.  What is left is compared in full: each member of a class with the class's smallest id; a
class whose texts differ after all is split again until it is one text.  All other rows of a text than its smallest id fail the filter.
Each document then has a mask of the filters it fails, counted by part and mask; the orders and steps are answered
from these counts (at most 32 a part) by one join with the table of steps, whose size is fixed.

Defined results: a null text is empty (so null and empty texts are duplicates of each other); a null part is the empty part; rows that repeat an id are
rows of their own, and of equal texts only rows with a larger id than the smallest fail E; a row without an id never fails E, and has no label; of several labels
of one id the larger value counts; rows of one id are told apart by length and block hashes; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table
from .exact_dedup import UPPER, hit_filter, may_hit

LETTERS = "ABCDE"
#: Code points of the first block, and how much longer each next one is.
FIRST_BLOCK, GROWTH = 256, 8
#: Candidates up to this number (about 8 MB) are broadcast to where the texts are read; beyond it they are joined by shuffle.
BROADCAST_CANDIDATES = 250_000
BLANKS = " \t\n\x0b\x0c\r"


def block_edges(length: int) -> list[tuple[int, int]]:
    """(start, end) of the blocks of a text of that many code points."""
    edges, size = [], FIRST_BLOCK
    while not edges or edges[-1][1] < length:
        lo = edges[-1][1] if edges else 0
        edges.append((lo, lo + size))
        size *= GROWTH
    return edges


def block_hashes(text: Column, edges: list[tuple[int, int]]) -> Column:
    """A hash of each block; blocks behind a text's end are all alike."""
    return F.array(*[F.xxhash64(F.substring(text, lo + 1, hi - lo)) for lo, hi in edges])


def _split_classes(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` without those that are alone under ``key``."""
    several = materialise(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), f"{name}-classes")
    return materialise(rows.join(several, key), name)  # both sides are plain exchanges: a hot class can be split


def refined(rows: DataFrame, blocks: int) -> DataFrame:
    """(id, len, c) of the rows (id, len, h) that share their length and all block hashes with another row."""
    left = _split_classes(rows, ["len"], "refined-len")
    for k in range(blocks):
        # the class after a step stands for all blocks so far
        left = left.withColumn("c", F.xxhash64(*([F.col("c")] if k else []), "len", F.col("h")[k]))
        left = _split_classes(left, ["len", "c"], f"refined-{k}")
    return left.select("id", "len", _all_blocks().alias("c"))


def _all_blocks() -> Column:
    return F.xxhash64("len", "h")


def same_texts(texts: DataFrame, left: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """(id, len, c, first): members of classes (id, len, c) with the smallest id of their text, by comparing the full ``texts`` (id, t).

    Only texts of candidates move: a filter of fixed size rules the others out where they are read."""
    left = materialise(left.distinct(), "candidates")
    small = left.limit(BROADCAST_CANDIDATES + 1).count() <= BROADCAST_CANDIDATES
    may = may_hit(texts.withColumn("digest", F.col("id")), hit_filter(left.select(F.col("id").alias("digest")))).drop("digest")
    keyed = may.withColumn("len", F.length("t")).withColumn("h", block_hashes(F.col("t"), edges)).select("id", "len", _all_blocks().alias("c"), "t")
    # an inner join: a semi-join would be pushed below the filter
    own = materialise(keyed.join(F.broadcast(left) if small else left, ["id", "len", "c"]), "class-texts")
    out = None
    while True:
        firsts = materialise(own.groupBy("len", "c").agg(F.min("id").alias("first")), "firsts")
        # under one id a class has one text, unless hashes collide: then the smallest of them leads this round
        heads = own.join(firsts, ["len", "c"]).where("id = first").groupBy("len", "c", "first").agg(F.min("t").alias("head"))
        heads = materialise(heads, "heads")
        judged = own.join(heads, ["len", "c"]).select("id", "len", "c", "first", F.when(F.col("t") != F.col("head"), F.col("t")).alias("t"))
        judged = materialise(judged, "judged")
        same = judged.where("t is null").select("id", "len", "c", "first")
        out = same if out is None else out.union(same)
        own = judged.where("t is not null").select("id", "len", "c", "t")
        if own.isEmpty():
            return out.distinct()


def failed(t: Column, words: Column, length: Column) -> Column:
    """Bits 1, 2, 4, 8 of the filters A to D that a text fails."""
    n = F.when(F.col("trimmed") == "", 0).otherwise(F.size(words))
    different = F.when(F.col("trimmed") == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = length - F.length(F.translate(t, UPPER, ""))
    conditions = [n < 50, 100 * different.cast("long") < 65 * n.cast("long"), 100 * capitals.cast("long") > 5 * length.cast("long"), t.rlike("[#$%&*|]")]
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)), F.lit(0)).cast("int")


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per input row: id, part, mask (bits of the filters A to E that it fails)."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    longest = plain.agg(F.max(F.length("t"))).first()[0]
    edges = block_edges(longest or 0)
    read = plain.withColumn("len", F.length("t")).withColumn("trimmed", F.btrim("t", F.lit(BLANKS))).withColumn("w", F.split("trimmed", "[ \t\n\x0b\f\r]+"))
    scanned = read.select("id", "part", "len", failed(F.col("t"), F.col("w"), F.col("len")).alias("mask"), block_hashes(F.col("t"), edges).alias("h"))
    scanned = materialise(scanned, "scanned")
    left = refined(scanned.where("id is not null").select("id", "len", "h"), len(edges))
    copies = same_texts(plain.where("id is not null").select("id", "t"), left, edges).where("id > first").select("id", "len", "c", F.lit(16).alias("e"))
    rows = scanned.withColumn("c", _all_blocks()).join(copies, ["id", "len", "c"], "left")
    return rows.select("id", "part", (F.col("mask") + F.coalesce("e", F.lit(0))).cast("int").alias("mask"))


def step_table(spark: SparkSession) -> DataFrame:
    """For each order, step and mask: what happens to a document with that mask (a table of fixed size, made from the rule)."""
    rows = []
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            for mask in range(32):
                fails, earlier = bool(mask & bit), bool(mask & before)
                rows.append((mask, "".join(order), step, int(not fails and not earlier), int(fails and not earlier), int(fails and earlier), int(mask == bit), 120 // mask.bit_count() if fails else 0))
            before |= bit
    return spark.createDataFrame(rows, "mask int, filter_order string, step int, k int, r int, d int, u int, s int")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A filter that a document fails removes it in the orders in which it stands before the document's other failed filters: 120 / number of failed
    filters of them, which is what ``shapley`` sums."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = masks(docs, id_col, text_col, part_col).join(own, "id", "left")
    counts = known.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    counts = materialise(counts, "mask-counts")
    met = counts.join(F.broadcast(step_table(docs.sparkSession)), "mask")
    total = lambda flag, n, name: F.sum(F.col(flag) * F.col(n)).alias(name)
    return met.groupBy("part", "filter_order", "step").agg(
        total("k", "n", "kept"), total("r", "n", "removed"), total("d", "n", "redundant"), total("u", "n", "unique_fails"), total("r", "good", "good_lost"), total("r", "toxic", "toxic_lost"), total("s", "n", "shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^ 	-
]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT doc_id, part, len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS C,
  regexp_matches(t, '[#$%&*|]') AS D, coalesce(doc_id > first, false) AS E FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, A::INT + 2 * B::INT + 4 * C::INT + 8 * D::INT + 16 * E::INT AS mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT p.c || q.c || r.c || s.c || t.c AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.c, q.c, r.c, s.c, t.c])) = 5),
st AS (SELECT filter_order, k::INT AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before FROM o, range(1, 6) z(k)),
g AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM m, st GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM g
"""
