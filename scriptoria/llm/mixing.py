"""Mixing sources to target weights by temperature (DataFrame and SQL operations only).

A source with token share s gets weight s**a / sum(s**a).  The exponent a in [0, 1] is found by bisection: the
largest one whose weights reach the target entropy (a fraction of the logarithm of the number of sources), but
never below the one at which the most repeated source meets the repetition limit.  The weights are realised as
budgeted block permutations: a source's documents are dealt by hash into blocks, blocks are permuted by hash,
and a source's token budget is spent on whole passes and then on a prefix of that permutation.  Running sums go
over blocks first and over the documents of the one boundary block of each source after that, so no task sees a
whole source.  The one row that holds all sources' totals has 16 bytes a source.

Tokens are words ``[^\\x20\\x09-\\x0D]+``.  Defined results: a null source is the source named ''; null and empty
texts have no tokens; a source without tokens has weight 0 and its rows are taken once (they cost nothing);
repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, fresh_name, materialise, read_table

#: Documents a block.
BLOCK_DOCS = 1024
STEPS = 50
WORD = r"[^\x20\x09-\x0D]+"


def exponent(sources: DataFrame, entropy_share: float, max_repeats: float, cover: bool) -> DataFrame:
    """One row: a, budget (tokens in all) and z (normaliser), from the sources' totals (columns source, n)."""
    one = sources.where("n > 0").agg(F.array_sort(F.collect_list(F.col("n").cast("double"))).alias("n"), F.sum("n").cast("double").alias("total"))
    power = "aggregate(s, 0D, (p, x) -> p + pow(x, {a}))"
    entropy = f"(ln({power}) - {{a}} * aggregate(s, 0D, (p, x) -> p + pow(x, {{a}}) * ln(x)) / {power})"
    # with cover, every document is taken at least once: the budget follows from the largest source
    repeats = "pow(s_max / s_min, 1 - {a})" if cover else f"(pow(s_min, {{a}} - 1) / {power})"
    bisect = "aggregate(sequence(1, {steps}), named_struct('lo', 0D, 'hi', 1D), (r, i) -> CASE WHEN {test} THEN {yes} ELSE {no} END)"
    mid = "((r.lo + r.hi) / 2)"
    low, high = f"named_struct('lo', {mid}, 'hi', r.hi)", f"named_struct('lo', r.lo, 'hi', {mid})"
    by_entropy = bisect.format(steps=STEPS, test=f"{entropy.format(a=mid)} >= h", yes=low, no=high)
    by_repeats = bisect.format(steps=STEPS, test=f"{repeats.format(a=mid)} <= {max_repeats}D", yes=high, no=low)
    found = (
        one.withColumn("s", F.expr("transform(n, x -> x / total)"))
        .withColumns({"s_min": F.expr("get(s, 0)"), "s_max": F.expr("get(s, size(s) - 1)"), "h": F.expr(f"{entropy_share}D * ln(size(s))")})
        .withColumn("a_entropy", F.expr(f"CASE WHEN {entropy.format(a='1D')} >= h THEN 1D ELSE {by_entropy}.lo END"))
        .withColumn("a_repeats", F.expr(f"CASE WHEN {repeats.format(a='0D')} <= {max_repeats}D THEN 0D ELSE {by_repeats}.hi END"))
        .withColumn("a", F.round(F.greatest("a_entropy", "a_repeats"), 9))
        .withColumn("z", F.expr(power.format(a="a")))
    )
    budget = F.expr("total * z * pow(s_max, 1 - a)") if cover else F.col("total")
    return found.select("a", "z", "total", budget.alias("budget"))


def mix(
    docs: DataFrame, entropy_share: float = 0.97, max_repeats: float = 4.0, cover: bool = False, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, source, n_tokens, weight, alpha, copies."""
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    ), "tokens")
    sources = materialise(rows.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs")), "sources")
    share = F.col("n") / F.col("total")
    plan = (
        sources.crossJoin(F.broadcast(exponent(sources, entropy_share, max_repeats, cover)))
        .withColumn("weight", F.when(F.col("n") > 0, F.pow(share, "a") / F.col("z")).otherwise(0.0))
        .withColumn("tokens", F.round(F.col("weight") * F.col("budget")).cast("long"))
        .withColumn("passes", F.when(F.col("n") > 0, F.floor(F.col("tokens") / F.col("n"))).otherwise(1).cast("long"))
        .withColumn("rest", F.when(F.col("n") > 0, F.col("tokens") - F.col("passes") * F.col("n")).otherwise(0).cast("long"))
        .withColumn("blocks", F.ceil(F.col("docs") / BLOCK_DOCS).cast("long"))
        .select("source", "weight", F.col("a").alias("alpha"), "passes", "rest", "blocks")
    )
    plan = materialise(plan, "plan")
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "id")), 1, 15), 16, 10).cast("long")
    dealt = rows.join(plan, "source").withColumn("h", hashed).withColumn("block", F.pmod("h", "blocks"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "source", F.col("block").cast("string")))
    blocks = dealt.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("t"))
    blocks = blocks.withColumn("until", F.sum("t").over(Window.partitionBy("source").orderBy(key, "block").rowsBetween(Window.unboundedPreceding, 0)))
    blocks = materialise(blocks.select("source", "block", (F.col("until") - F.col("t")).alias("before"), "until"), "blocks")
    placed = dealt.join(blocks, ["source", "block"])
    inside = (F.col("before") < F.col("rest")) & (F.col("until") > F.col("rest"))
    whole = placed.where(~inside).withColumn("taken", F.col("until") <= F.col("rest"))
    w = Window.partitionBy("source", "block").orderBy("h", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.where(inside).withColumn("taken", F.col("before") + F.sum("n_tokens").over(w) <= F.col("rest"))
    both = whole.unionByName(cut)
    return both.select("id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "alpha", (F.col("passes") + F.when(F.col("taken") & (F.col("rest") > 0), 1).otherwise(0)).cast("long").alias("copies"))


def mixed_rows(docs: DataFrame, entropy_share: float = 1.0, max_repeats: float = 2.0, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every row repeated as the mixture asks, at least once each; columns unchanged.

    Rows without an id are taken once.
    """
    own, copies, n = (fresh_name(docs, x) for x in ("own", "copies", "n"))
    more = mix(docs, entropy_share, max_repeats, cover=True, id_col=id_col).where("copies > 1 and id is not null").groupBy("id").agg(F.max("copies").alias("copies"))
    more = materialise(more.toDF(own, copies), "copies")
    small = more.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    joined = docs.join(F.broadcast(more) if small else more, F.col(id_col).cast("long") == F.col(own), "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce(copies, F.lit(1).cast("long")))
    return joined.withColumn(n, F.explode(times)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _sql(entropy_share: float = 0.97, max_repeats: float = 4.0, seed: int = 7) -> str:
    power = "list_sum(list_transform(s, lambda x: pow(x, {a})))"
    entropy = f"(ln({power}) - {{a}} * list_sum(list_transform(s, lambda x: pow(x, {{a}}) * ln(x))) / {power})"
    repeats = f"(pow(s_min, {{a}} - 1) / {power})"
    mid = "((lo + hi) / 2)"
    return f"""
WITH RECURSIVE r AS (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
src AS (SELECT source, sum(n_tokens)::BIGINT AS n, count(*) AS docs FROM r GROUP BY 1),
one AS (SELECT list_transform(ns, lambda x: x / total) AS s, total FROM (SELECT list(n::DOUBLE ORDER BY n) AS ns, sum(n)::DOUBLE AS total FROM src WHERE n > 0)),
one2 AS (SELECT *, s[1] AS s_min, {entropy_share} * ln(len(s)) AS h FROM one),
be AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
  SELECT i + 1, CASE WHEN {entropy.format(a=mid)} >= h THEN {mid} ELSE lo END, CASE WHEN {entropy.format(a=mid)} >= h THEN hi ELSE {mid} END FROM be, one2 WHERE i < {STEPS}),
br AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
  SELECT i + 1, CASE WHEN {repeats.format(a=mid)} <= {max_repeats} THEN lo ELSE {mid} END, CASE WHEN {repeats.format(a=mid)} <= {max_repeats} THEN {mid} ELSE hi END FROM br, one2 WHERE i < {STEPS}),
al AS (SELECT round(greatest(CASE WHEN {entropy.format(a='1.0')} >= h THEN 1.0 ELSE (SELECT lo FROM be WHERE i = {STEPS}) END,
  CASE WHEN {repeats.format(a='0.0')} <= {max_repeats} THEN 0.0 ELSE (SELECT hi FROM br WHERE i = {STEPS}) END), 9) AS a, s, total FROM one2),
alz AS (SELECT a, total, {power.format(a='a')} AS z FROM al),
plan AS (SELECT source, n, a, CASE WHEN n > 0 THEN pow(n / total, a) / z ELSE 0.0 END AS w, total, ceil(docs / {BLOCK_DOCS}.0)::BIGINT AS blocks FROM src, alz),
plan2 AS (SELECT *, round(w * total)::BIGINT AS tokens FROM plan),
plan3 AS (SELECT *, CASE WHEN n > 0 THEN tokens // n ELSE 1 END AS passes, CASE WHEN n > 0 THEN tokens % n ELSE 0 END AS rest FROM plan2),
dealt AS (SELECT r.*, p.w, p.a, p.passes, p.rest, p.blocks, ('0x' || substr(md5('{seed}:' || doc_id), 1, 15))::BIGINT AS h FROM r JOIN plan3 p USING (source)),
cum AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY md5('{seed}:' || source || ':' || (h % blocks)), h % blocks, h, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS c FROM dealt)
SELECT doc_id, source, n_tokens, round(w, 9) AS weight, a AS alpha, (passes + CASE WHEN rest > 0 AND c <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM cum"""


OP4_SQL = _sql()
