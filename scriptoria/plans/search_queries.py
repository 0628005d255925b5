"""Search over the documents: queries of the written index, cover density, facets.

The catalog of the searched documents: orders are containers, the document of the same number stands in each (author: source, type: language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.operators import catalog as C
from scriptoria.operators import postings as P
from scriptoria.operators import search as S
from scriptoria.scratch import scratch_path

from .registering import query
from .roles import containers, table

_BUILT: dict[tuple[str, str, str], P.Index] = {}


def text_index(spark: SparkSession, sf_dir: str, stemmed: bool = False) -> P.Index:
    """The written index of all texts: made once a session and folder, then read from the shared folder by every query."""
    key = (spark.sparkContext.applicationId, sf_dir, f"texts-{stemmed}")
    if key not in _BUILT:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        _BUILT[key] = P.write_index(docs, ["doc_id"], [("text", "C")], scratch_path(spark, "index"), S.Config(stemmed=stemmed))
    return _BUILT[key]


def searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner documents of the catalog: one in each container that has a text."""
    day = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slug"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("creationRaw"), F.year("o_orderdate").alias("siteYear"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("slug"), F.lit(1).alias("position"), F.col("source").alias("authorName"), F.lit(None).cast("string").alias("authorRaw"), F.col("source").alias("authorSlug"),
        F.col("lang").alias("documentType"), F.substring("text", 1, 30).alias("documentTitle"), F.lit(None).cast("string").alias("description"), F.col("text").alias("content"))
    return docs.join(day, "slug")


def catalog_index(spark: SparkSession, sf_dir: str) -> P.Index:
    """The index of all fields of the catalog's documents, in blocks by year."""
    key = (spark.sparkContext.applicationId, sf_dir, "catalog")
    if key not in _BUILT:
        _BUILT[key] = P.catalog_index(searched(spark, sf_dir), scratch_path(spark, "catalog-index"), S.PLAIN, F.col("siteYear"))
    return _BUILT[key]


_TOKENS = r"w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents), t AS (SELECT doc_id, unnest(ws) AS term, unnest(range(1, len(ws) + 1)) AS pos, 0.2::DOUBLE AS w FROM w)"
_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
_FIELDS = f"""c AS (SELECT o_orderkey, year(o_orderdate)::INT AS siteYear, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
f AS (SELECT doc_id, siteYear, source, lang, {_WORDS.format("coalesce(source, '')")} AS a, {_WORDS.format("coalesce(substr(text, 1, 30), '')")} AS b, {_WORDS.format("day")} AS y, {_WORDS.format("coalesce(text, '')")} AS x FROM documents JOIN c ON o_orderkey = doc_id),
w AS (SELECT doc_id, siteYear, source, lang, len(a) + len(b) AS n, len(y) AS m, list_concat(list_concat(a, b), list_concat(y, x)) AS ws FROM f),
u AS (SELECT *, unnest(ws) AS term, unnest(range(1, len(ws) + 1)) AS pos FROM w),
t AS (SELECT doc_id, siteYear, source, lang, term, pos, CASE WHEN pos <= n THEN 1.0 WHEN pos <= n + m THEN 0.4 ELSE 0.2 END::DOUBLE AS w FROM u)"""


def _covers(*terms: str) -> str:
    """Common table expressions e, l, v and ``scores`` (doc_id, score): the minimal covers of all terms over ``t``."""
    last = [f"max(i) FILTER (WHERE term = '{t}') OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)" for t in terms]
    every = " AND ".join(f"l{k} IS NOT NULL" for k in range(len(terms)))
    return f"""e AS (SELECT doc_id, pos, w, term, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, sum(1 / w) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum FROM t WHERE term IN ({', '.join(f"'{t}'" for t in terms)})),
l AS (SELECT doc_id, i, {', '.join(f'{x} AS l{k}' for k, x in enumerate(last))} FROM e),
v AS (SELECT doc_id, least({', '.join(f'l{k}' for k in range(len(terms)))}) AS b, min(i) AS i FROM l WHERE {every} GROUP BY 1, 2),
scores AS (SELECT v.doc_id, round(sum((v.i - v.b + 1) / (x.cum - z.cum + 1 / z.w) / (1 + (x.pos - z.pos) - (v.i - v.b))), 6) AS score FROM v JOIN e x ON x.doc_id = v.doc_id AND x.i = v.i JOIN e z ON z.doc_id = v.doc_id AND z.i = v.b GROUP BY 1)"""


def _found(spark: SparkSession, sf_dir: str, q: str, universe: DataFrame | None = None) -> DataFrame:
    return P.matching(text_index(spark, sf_dir), spark, q, universe)


@query(f"WITH {_TOKENS} SELECT doc_id FROM t WHERE term IN ('tion', 'with', 'ering') GROUP BY 1 HAVING count(DISTINCT term) = 3")
def fts_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, "tion with ering")


@query(f"WITH {_TOKENS} SELECT DISTINCT a.doc_id FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 JOIN t c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2 WHERE a.term = 'of' AND b.term = 'the' AND c.term = 'and'")
def fts_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, '"of the and"')


@query(f"WITH {_TOKENS} SELECT doc_id FROM t WHERE term = 'the' GROUP BY 1 EXCEPT SELECT doc_id FROM t WHERE term = 'with'")
def fts_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, "the -with")


@query(f"WITH {_TOKENS} SELECT DISTINCT doc_id FROM t WHERE term IN ('ering', 'und')")
def fts_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, "ering or und")


@query(f"WITH {_TOKENS} SELECT doc_id FROM documents EXCEPT SELECT a.doc_id FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the'")
def fts_only_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, '-"of the"', table(spark, sf_dir, "documents"))


@query(f"WITH {_TOKENS} SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS places FROM t GROUP BY 1")
def fts_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index(spark, sf_dir).terms(spark).select("term", "documents", "places")


def _scored(index: P.Index, spark: SparkSession, q: str) -> DataFrame:
    return P.matching(index, spark, q, scored=True).withColumn("score", F.round("score", 6))


@query(f"WITH {_TOKENS}, {_covers('the')} SELECT doc_id, score FROM scores")
def fts_cover_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(text_index(spark, sf_dir), spark, "the the")


@query(f"WITH {_TOKENS}, {_covers('of', 'the')} SELECT doc_id, score FROM scores")
def fts_cover_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(text_index(spark, sf_dir), spark, "of the")


@query(f"WITH {_TOKENS}, {_covers('tion', 'with', 'ering')} SELECT doc_id, score FROM scores")
def fts_cover_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(text_index(spark, sf_dir), spark, "tion with ering")


@query(r"""WITH f AS (SELECT doc_id, source AS x, 1.0::DOUBLE AS w FROM documents UNION ALL SELECT doc_id, text, 0.2::DOUBLE FROM documents), t AS (SELECT doc_id, unnest(regexp_extract_all(lower(x), '[\p{L}\p{N}_]+')) AS term, w FROM f)
SELECT doc_id, round(sum(w), 6) AS score FROM t WHERE term IN ('src1', 'the', 'of') GROUP BY 1""")
def fts_weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = S.token_table(table(spark, sf_dir, "documents"), ["doc_id"], [("source", "A"), ("text", "C")])
    return S.scores(tokens, ["doc_id"], "src1 the of").select("doc_id", F.round("score", 6).alias("score"))


# The documents' words that have the stem of "tioning".
_TIONING = ["tion", "tioning", "tioned", "tionly", "tiones", "tionlying", "tioningly", "tionedly", "tionlyed"]


@query(f"WITH {_TOKENS} SELECT DISTINCT doc_id FROM t WHERE term IN {tuple(_TIONING)}")
def fts_stemmed_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.matching(text_index(spark, sf_dir, stemmed=True), spark, "tioning")


@query(f"WITH {_FIELDS}, {_covers('the', 'of')} SELECT doc_id AS slug, siteYear, score, (row_number() OVER (ORDER BY score DESC, doc_id))::INT AS place FROM scores JOIN w USING (doc_id)")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _scored(catalog_index(spark, sf_dir), spark, "the of").join(containers(spark, sf_dir).select("slug", "siteYear"), "slug")
    return found.select("slug", "siteYear", "score", F.row_number().over(Window.orderBy(F.desc("score"), "slug")).alias("place"))


@query(f"WITH {_FIELDS}, {_covers('the', '1995')} SELECT doc_id AS slug, siteYear, score, source AS author, lang AS kind FROM scores JOIN w USING (doc_id) WHERE siteYear = 1995 AND source = 'src0' AND lang = 'en'")
def search_with_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three facets: they choose the documents, whose blocks and bitmaps restrict the postings that are read."""
    filters = C.Filters.of(siteYear="1995", authorSlug="src0", documentType="en", q="the 1995")
    found = P.found_catalog(containers(spark, sf_dir), searched(spark, sf_dir).drop("siteYear"), catalog_index(spark, sf_dir), filters)
    one = F.get("documents", F.lit(0))
    return found.select("slug", "siteYear", F.round(one["score"], 6).alias("score"), one["authorSlug"].alias("author"), one["documentType"].alias("kind"))


# Inflected words for the parts' keys; the query's word is another form of the first three.
_INFLECTED = ["мудрость", "мудрости", "мудростями", "мудрый", "лекция", "лекциями", "о", "света", "свет", "учение"]


@query(f"SELECT p_partkey FROM (SELECT p_partkey, {_INFLECTED}[p_partkey % 10 + 1] AS a, {_INFLECTED}[(p_partkey // 10) % 10 + 1] AS b FROM part) WHERE (a IN ('мудрость', 'мудрости', 'мудростями') OR b IN ('мудрость', 'мудрости', 'мудростями')) AND NOT (a IN ('свет', 'света') OR b IN ('свет', 'света'))")
def fts_stemmed_ru(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda k: F.get(F.array(*[F.lit(w) for w in _INFLECTED]), (k % 10).cast("int"))
    key = F.col("p_partkey")
    docs = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", F.lit("О"), word(key), F.lit("и"), word(F.floor(key / 10))).alias("text"))
    index = P.write_index(docs, ["p_partkey"], [("text", "A")], scratch_path(spark, "index-ru"), S.Config.russian(spark))
    return P.matching(index, spark, "мудростью -светом")
