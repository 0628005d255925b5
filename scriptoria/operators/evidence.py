"""Containment of claimed lines in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Inner words of a claim that are joined at most, and characters of a short claim's longest word that are joined and looked for.
INNER, GRAM, PROBE = 3, 3, 16


def _words(c: str):
    return F.filter(F.split(c, r"[\s]+"), lambda w: F.length(w) > 0)


def _grams(words, k: int):
    """Distinct hashes of each ``k`` consecutive words."""
    at = F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(k))))
    return F.array_distinct(F.when(F.size(words) >= k, at).otherwise(F.array().cast("array<bigint>")))


def _blocks(word: str):
    """Pieces of a word, one at every ``PROBE`` characters, each long enough to hold a probe that begins in its first ``PROBE`` characters."""
    at = F.sequence(F.lit(1), F.length(word), F.lit(PROBE))
    return F.array_distinct(F.transform(at, lambda i: F.substr(F.col(word), i, F.lit(2 * PROBE - 1))))


def claims_in_texts(claims: DataFrame, texts: DataFrame, claim_key: str, claim: str, text_key: str, text: str) -> DataFrame:
    """(claim_key, text_key) of all texts that contain a claim as a substring; a blank claim is none.

    A claim's inner words are whole words of any text that holds it, so one to three of them meet the texts' words or word runs in an
    equi-join.  The longest word of a claim without inner words lies within a word of the text, so its first characters meet the blocks
    of the vocabulary of all texts: a word of any length is as many rows of bounded size as it has blocks, known by its hash.  Only the
    pairs found this way are compared.
    """
    c = claims.select(F.col(claim_key).alias("_ck"), F.col(claim).alias("_c"), _words(claim).alias("_w")).withColumn("_n", F.size("_w")).where("_n > 0")
    w = texts.select(F.col(text_key).alias("_tk"), F.col(text).alias("_t"), _words(text).alias("_w")).where("_t is not null")
    lengths = F.when(F.col("_n") >= INNER + 2, INNER).otherwise(F.greatest(F.col("_n") - 2, F.lit(0)))
    c = c.withColumn("_k", lengths)
    found = None
    for k in range(1, INNER + 1):
        own = c.where(F.col("_k") == k).select("_ck", F.xxhash64(F.slice("_w", 2, k)).alias("_h"))
        pairs = w.select("_tk", F.explode(_grams(F.col("_w"), k)).alias("_h")).join(own, "_h").select("_tk", "_ck")
        found = pairs if found is None else found.union(pairs)
    longest = F.array_max(F.transform("_w", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    short = c.where("_k = 0").select("_ck", longest.alias("_x"))
    placed = w.select("_tk", F.explode(F.array_distinct("_w")).alias("_v")).withColumn("_h", F.xxhash64("_v"))
    blocks = placed.select("_h", F.explode(_blocks("_v")).alias("_b")).distinct()
    starts = F.sequence(F.lit(1), F.least(F.length("_b"), F.lit(PROBE)))
    grams = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.substr(F.col("_b"), i, n)))))
    probes = short.select("_ck", F.substring("_x", 1, PROBE).alias("_p"), F.substring("_x", 1, GRAM).alias("_g"))
    words = blocks.select("_h", "_b", F.explode(grams).alias("_g")).join(probes, "_g").where(F.col("_b").contains(F.col("_p"))).select("_h", "_ck").distinct()
    found = found.union(placed.select("_tk", "_h").join(words, "_h").select("_tk", "_ck")).distinct()
    both = found.join(c.select("_ck", "_c"), "_ck").join(w.select("_tk", "_t"), "_tk")
    return both.where(F.col("_t").contains(F.col("_c"))).select("_ck", "_tk").distinct().toDF(claim_key, text_key)
