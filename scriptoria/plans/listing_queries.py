"""Archive queries over listings, maps and issues that are made from the orders' keys and dates; each oracle applies the rule in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.operators import archive as A
from scriptoria.operators import exports
from scriptoria.sources import archive_files
from scriptoria.sources.parsed_json import export_items as items_of

from .registering import query
from .roles import DOCUMENTS, documents
from .rule_queries import _K, _M, _NAME, _ORDERS, _Q, _Y, _orders, _pick

_SLUG = f"concat({_Y}, 'Q', {_Q}, '-', cast((m - 1) % 3 + 1 as string))"
_DIR = f"concat({_Y}, '/Q', {_Q}, '/')"


def _made(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    """Orders with columns made by expressions that both engines have."""
    return _orders(spark, sf_dir).withColumns({name: F.expr(e) for name, e in columns.items()})


def _with(**columns: str) -> str:
    """The same rows as common table expression ``i``."""
    return f"WITH {_ORDERS}, i AS (SELECT *, " + ", ".join(f'{e} AS "{name}"' for name, e in columns.items()) + " FROM o)"


# Files of five kinds: named by month, printed brochure, notes, without a year, English month folder.
_LISTED = _pick([
    f"concat({_DIR}, 'word/', {_NAME}, ' ', {_Y}, ' n', {_K}, '.docx')", f"concat({_DIR}, 'Печать/Брошюра ', {_K}, '.pdf')", f"concat({_Y}, '/old/notes ', {_K}, '.txt')", f"concat('misc/R', {_K})",
    f"concat({_Y}, '/', lpad({_M}, 2, '0'), '_', english, '/plain', {_K}, '.pdf')"], "k")
_LATIN = "['yanvar','fevral','mart','aprel','may','iyun','iyul','avgust','sentyabr','oktyabr','noyabr','dekabr']"
_FORMAT = "CASE k % 5 WHEN 0 THEN 'word' WHEN 1 THEN 'pdf-print' WHEN 4 THEN 'pdf-mailing' ELSE 'originals' END"


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.listing(_made(spark, sf_dir, relativePath=_LISTED).select("relativePath", F.length("relativePath").cast("long").alias("size")))


@query(f"""{_with(path=_LISTED)}, n AS (SELECT path, k, y, m, q, {_FORMAT} AS format,
CASE k % 5 WHEN 0 THEN y || 'Q' || q || '-' || ((m - 1) % 3 + 1) WHEN 4 THEN y || 'Q' || q || '-' || ((m - 1) % 3 + 1) WHEN 1 THEN y || '-broshyura-' || k WHEN 2 THEN y || '-notes-' || k ELSE 'r' || k END AS base,
CASE k % 5 WHEN 0 THEN {_LATIN}[m] || '-' || y || '-n' || k WHEN 4 THEN 'plain' || k ELSE '' END AS own, CASE k % 5 WHEN 0 THEN '.docx' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.pdf' END AS ext,
CASE WHEN k % 5 = 3 THEN 'archive' ELSE y::VARCHAR END || '/' || CASE WHEN k % 5 IN (2, 3) THEN 'Q0' ELSE 'Q' || q END AS dir FROM i),
r AS (SELECT *, row_number() OVER (PARTITION BY dir, format, base, ext ORDER BY path) AS place FROM n)
SELECT path AS "oldPath", dir || '/' || format || '/' || base || CASE WHEN place > 1 THEN '-' || own ELSE '' END || ext AS "newPath", CASE WHEN k % 5 <> 3 THEN y END AS year,
CASE WHEN k % 5 NOT IN (2, 3) THEN q END AS quarter, CASE WHEN k % 5 IN (0, 4) THEN m END AS month, format FROM r""")
def source_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.source_map(_listing(spark, sf_dir)).select("oldPath", "newPath", "year", "quarter", "month", "format")


@query(f"""{_with(path=_LISTED)}, s AS (SELECT string_split(path, '/') AS p FROM i), a AS (SELECT DISTINCT array_to_string(p[1 : n], '/') AS dir FROM (SELECT p, unnest(range(1, len(p))) AS n FROM s)),
e AS (SELECT CASE k % 5 WHEN 0 THEN '.docx' WHEN 2 THEN '.txt' WHEN 3 THEN '[none]' ELSE '.pdf' END AS key, count(*) AS n FROM i GROUP BY 1),
y AS (SELECT CASE WHEN k % 5 = 3 THEN 'unknown' ELSE y::VARCHAR END AS key, count(*) AS n FROM i GROUP BY 1), f AS (SELECT {_FORMAT} AS key, count(*) AS n FROM i GROUP BY 1)
SELECT (SELECT count(*) FROM i) AS files, (SELECT count(*) FROM a) AS directories, (SELECT string_agg(key || '=' || n, ',' ORDER BY key) FROM e) AS extensions, (SELECT string_agg(key || '=' || n, ',' ORDER BY key) FROM y) AS years,
(SELECT string_agg(key || '=' || n, ',' ORDER BY key) FROM f) AS formats, (SELECT md5(string_agg(path, '|' ORDER BY length(path) DESC, path)) FROM (SELECT path FROM i ORDER BY length(path) DESC, path LIMIT 25)) AS longest""")
def archive_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return A.audit(_listing(spark, sf_dir)).select(
        F.col("filesCount").alias("files"), "directories", record("extensionCounts").alias("extensions"), record("yearCounts").alias("years"), record("formatCounts").alias("formats"), F.md5(F.array_join("longestPaths", "|")).alias("longest"))


# Candidates of an issue's source, from the best kind to none; a month's kinds begin at its own, so that each kind wins somewhere.
_KIND = "greatest(k % 7, m % 6)"
_CANDIDATE = f"concat({_DIR}, " + _pick([f"concat('word/', {_SLUG}, '.docx')", f"concat('Брошюры/', {_SLUG}, '.doc')", f"concat('word/', {_SLUG}, '.pdf')", f"concat('Рассылка ', {_Y}, '/', {_SLUG}, '.pdf')", f"concat('Печать/', {_SLUG}, '.pdf')",
                                         f"concat('word/', {_SLUG}, ' new.doc')", f"concat('word/~$', {_SLUG}, '.doc')"], _KIND) + ")"


@query(f"{_with(path=_CANDIDATE, slug=_SLUG)} SELECT slug, arg_min(path, (({_KIND}), path)) AS path, min({_KIND} + 1)::INT AS rank FROM i WHERE {_KIND} < 5 GROUP BY 1")
def preferred_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.preferred_sources(_made(spark, sf_dir, relativePath=_CANDIDATE).select("relativePath")).select("slug", F.col("relativePath").alias("path"), "rank")


@query(f"{_with(path=_CANDIDATE, slug=_SLUG)} SELECT slug || '.docx' AS prepared, arg_min(path, (({_KIND}), path)) AS source FROM i WHERE {_KIND} < 2 GROUP BY 1")
def prepared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, relativePath=_CANDIDATE, slug=_SLUG)
    prepared = rows.where(F.expr(f"{_KIND} < 2")).select(F.concat("slug", F.lit(".docx")).alias("relativePath")).distinct()
    return A.prepared_sources(prepared, rows.select("relativePath")).select(F.col("relativePath").alias("prepared"), F.col("sourcePath").alias("source"))


_WORD = f"concat({_DIR}, 'b', {_K}, '/word/', {_SLUG}, CASE WHEN m % 3 = 0 AND k % 2 = 0 THEN '.docx' ELSE '.doc' END)"
_HEAD = _pick(["'504B0304'", "'504B'", "'D0CF11E0'", "'D0CF11E0A1'", "'504B0506'"], "k")


@query(f"""{_with(path=_WORD, slug=_SLUG, head=_HEAD)}, b AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY CASE WHEN path LIKE '%.docx' THEN 0 ELSE 1 END, path) AS r FROM i)
SELECT path, CASE WHEN m % 2 = 0 AND 500 >= k % 1000 THEN 'skipped' WHEN path LIKE '%.docx' THEN CASE WHEN head LIKE '504B____%' THEN 'copied' ELSE 'skipped-invalid' END WHEN head LIKE 'D0CF11E0%' THEN 'converted' ELSE 'skipped-invalid' END AS outcome FROM b WHERE r = 1""")
def prepare_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, relativePath=_WORD, slug=_SLUG, head=_HEAD)
    files = rows.select("relativePath", (F.col("k") % 1000).alias("mtime"), F.unhex("head").alias("head"))
    outputs = rows.where("m % 2 = 0").select(F.concat(F.expr(_DIR), F.lit("word/"), "slug", F.lit(".docx")).alias("relativePath"), F.lit(500).cast("long").alias("mtime")).distinct()
    return A.prepare_outcome(A.preferred_word_sources(A.word_sources(files)), outputs).select(F.col("relativePath").alias("path"), "outcome")


_OUTCOME = _pick(["'converted'", "'skipped'", "'would-copy'", "'skipped'", "'copied'"], "k")


@query(f"{_with(outcome=_OUTCOME)} SELECT d.k AS key, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('converted'), ('copied'), ('skipped'), ('skipped-invalid'), ('would-convert'), ('would-copy')) d(k) LEFT JOIN (SELECT outcome, count(*) AS n FROM i GROUP BY 1) ON outcome = d.k")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.outcome_counts(_made(spark, sf_dir, outcome=_OUTCOME))


@query(f"""WITH {_ORDERS} SELECT CASE k % 4 WHEN 3 THEN 'd' || k ELSE 'a/x' || k || '.doc' END AS "oldPath", ['moved', 'move', 'missing', 'keep'][k % 4 + 1] AS status FROM o""")
def move_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, oldPath=f"CASE k % 4 WHEN 3 THEN concat('d', {_K}) ELSE concat('a/x', {_K}, '.doc') END", newPath=f"CASE k % 4 WHEN 3 THEN concat('d', {_K}) ELSE concat('n/x', {_K}, '.doc') END")
    here = rows.where("k % 4 = 0").select(F.col("newPath").alias("relativePath")).union(rows.where("k % 4 = 1").select("oldPath"))
    return A.move_plan(rows.select("oldPath", "newPath"), here).select("oldPath", "status")


_ASKED = _pick([f"concat('A/Y', {_K}, '.docx')", f"concat('n/y', {_K}, '.DOC')", f"concat('no/', {_K})"], "k")


@query(f"{_with(path=_ASKED)} SELECT path, CASE WHEN k % 3 < 2 THEN 'a/y' || k || '.doc' END AS found FROM i")
def source_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, path=_ASKED, low=f"concat('a/y', {_K}, '.doc')", new=f"concat('n/y', {_K}, '.doc')")
    items = rows.select(F.col("k").alias("item_pos"), F.col("low").alias("oldPath"), F.col("new").alias("newPath"))
    later = items.select((F.col("item_pos") + 1_000_000_000_000).alias("item_pos"), F.replace("oldPath", F.lit("y"), F.lit("Y")).alias("oldPath"), F.lit("other").alias("newPath"))
    return A.map_lookup(rows.select("path"), items.union(later)).select("path", F.col("item.oldPath").alias("found"))


_STORED = _pick([f"concat('data/source-data/a', {_K}, '.doc')", f"concat('data/source-data/pearls-word/a', {_K}, '.doc')", f"concat('data/source-data/c', {_K}, '.doc')"], "k")


@query(f"""{_with(path=_STORED)} SELECT path AS "sourcePath", 'T' || k AS title, k % 9 AS expected FROM i WHERE k % 3 < 2""")
def override_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, sourcePath=_STORED, key=f"concat('data/source-data/', CASE WHEN k % 2 = 0 THEN 'pearls-word/' ELSE '' END, 'a', {_K}, '.doc')")
    value = F.concat(F.lit('{"files": {"'), "key", F.lit('": {"expectedDocuments": '), (F.col("k") % 9).cast("string"), F.lit(', "documents": [{"title": "T'), F.col("k").cast("string"), F.lit('"}]}}}'))
    found = A.override_lookup(rows.select("sourcePath"), archive_files.overrides(rows.select(value.alias("value"))))
    return found.select("sourcePath", F.get("titles", F.lit(0)).alias("title"), F.col("expectedDocuments").cast("long").alias("expected"))


@query(f"""WITH {DOCUMENTS} SELECT 's' || slug AS slug, position, CASE WHEN slug % 2 = 0 THEN 2 END AS expected, CASE WHEN slug % 2 = 0 AND position = 1 THEN 'A' || slug WHEN slug % 2 = 0 AND position = 2 THEN 'B' END AS title FROM d""")
def legacy_catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, y = F.col("k").cast("string"), F.col("y").cast("string")
    text = F.concat(F.lit('{"lectures": [{"year": "'), y, F.lit('", "title": "A'), k, F.lit('", "href": "/x/s'), k, F.lit('.html", "authors": [{"name": " N "}]}, {"year": "'), y, F.lit('", "title": " B ", "href": "/y/s'), k,
                    F.lit('.pdf"}, {"title": "no year", "href": "/s'), k, F.lit('.html"}]}'))
    legacy = archive_files.legacy_catalog(_orders(spark, sf_dir).where("k % 2 = 0").select(text.alias("value")))
    docs = documents(spark, sf_dir).select(F.concat(F.lit("s"), F.col("slug").cast("string")).alias("slug"), "position")
    return archive_files.legacy_reference(docs, legacy).select("slug", "position", F.col("expectedDocuments").alias("expected"), F.col("legacyDocument.title").alias("title"))


# PDFs of an issue, from the exact mailing name to files that are none of its own.
_OFFER = "greatest(k % 6, m % 6)"
_PDF = f"concat({_DIR}, " + _pick([f"concat('pdf-mailing/', {_SLUG}, '.pdf')", f"concat('Рассылка/', {_SLUG}, ' new', {_K}, '.pdf')", f"concat('Печать/Брошюра ', {_M}, '.pdf')", f"concat('word/', {_SLUG}, '.pdf')", f"concat('other/x', {_K}, '.pdf')",
                                   f"concat('pdf-mailing/', {_SLUG}, '.txt')"], _OFFER) + ")"


@query(f"""{_with(path=_PDF, slug=_SLUG)}, b AS (SELECT slug, arg_min(path, (({_OFFER}), path)) AS pdf, min({_OFFER} + 1)::INT AS rank FROM i WHERE {_OFFER} < 4 GROUP BY 1)
SELECT s.slug, pdf, rank FROM (SELECT DISTINCT slug FROM i) s LEFT JOIN b ON b.slug = s.slug""")
def pdf_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, relativePath=_PDF, slug=_SLUG, sourcePath=f"concat({_DIR}, 'word/', {_SLUG}, '.doc')")
    return exports.pdf_choice(rows.select("slug", "sourcePath").distinct(), rows.select("relativePath")).select("slug", "pdf", F.col("pdfRank").alias("rank"))


def _paths_of(rows: DataFrame, *present: str) -> DataFrame:
    """relativePath of the files that each of some expressions names (null: none)."""
    return rows.select(F.explode(F.array(*[F.expr(e) for e in present])).alias("relativePath")).where("relativePath is not null")


@query(f"{_with(slug=_K)} SELECT slug, CASE k % 5 WHEN 0 THEN 'p/' || k || '.docx' WHEN 1 THEN 'w/' || k || '.docx' WHEN 2 THEN 'w/' || k || '.doc' WHEN 4 THEN 'w/' || k || '.doc' END AS word FROM i")
def word_for_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, slug=_K, sourcePath=f"concat('w/', {_K}, CASE WHEN k % 5 IN (0, 4) THEN '.doc' ELSE '.pdf' END)", preparedDocx=f"CASE WHEN k % 5 IN (0, 4) THEN concat('p/', {_K}, '.docx') END")
    files = _paths_of(rows, f"CASE WHEN k % 5 = 0 THEN concat('p/', {_K}, '.docx') END", f"CASE WHEN k % 5 IN (0, 1, 2, 4) THEN concat('w/', {_K}, '.doc') END", f"CASE WHEN k % 5 IN (0, 1, 4) THEN concat('w/', {_K}, '.docx') END")
    return exports.word_for_pdf(rows.select("slug", "sourcePath", "preparedDocx"), files).select("slug", "word")


@query(f"{_with(slug=_K)} SELECT slug, CASE k % 5 WHEN 0 THEN 'a/x' || k WHEN 1 THEN 'a/y' || k WHEN 2 THEN 'm/z' || k WHEN 3 THEN 'gone/' || k ELSE 'a/x' || k END AS path FROM i")
def existing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, slug=_K, mappedPath=f"CASE WHEN k % 5 IN (2, 4) THEN concat('m/z', {_K}) END",
                 sourcePath=_pick([f"concat('a/x', {_K})", f"concat('a/pearls-word/y', {_K})", f"concat('b/', {_K})", f"concat('gone/', {_K})", f"concat('a/x', {_K})"], "k"))
    files = _paths_of(rows, f"concat('m/z', {_K})", f"concat('a/y', {_K})", f"CASE WHEN k % 5 IN (0, 4) THEN concat('a/x', {_K}) END")
    return exports.existing_path(rows.select("slug", "sourcePath", "mappedPath"), files).select("slug", F.col("existingPath").alias("path"))


_MAPPED = _pick([f"concat('data/source-data/a', {_K}, '.doc')", f"concat('n/a', {_K}, '.doc')", f"concat('c', {_K}, '.doc')", f"concat('data/source-data/pearls-word/a', {_K}, '.doc')"], "k")


@query(f"{_with(path=_MAPPED)} SELECT path, CASE WHEN k % 4 <> 2 THEN 'A' || k || '.doc' END AS name FROM i")
def map_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, path=_MAPPED, originalName=f"concat('A', {_K}, '.doc')", oldPath=f"concat('a', {_K}, '.doc')", newPath=f"concat('n/a', {_K}, '.doc')")
    return A.map_metadata(rows.select("path"), rows.select(F.col("k").alias("item_pos"), "originalName", "oldPath", "newPath")).select("path", F.col("sourceMap.originalName").alias("name"))


@query(f"{_with(slug=_K)} SELECT slug, 'docx' AS format, 'disk full ' || m AS error FROM i WHERE k % 3 = 0")
def settled_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, slug=_K, format="CASE WHEN k % 3 = 0 THEN 'docx' ELSE 'txt' END", error=f"CASE WHEN k % 3 = 0 THEN concat('disk full ', {_M}) END")
    return exports.settled(rows)


@query(f"""{_with(slug=_K)} SELECT slug, CASE k % 4 WHEN 0 THEN y::VARCHAR WHEN 1 THEN (y - 1)::VARCHAR WHEN 2 THEN (y - 2)::VARCHAR ELSE 'archive' END AS year, CASE WHEN k % 2 = 0 THEN 'w/' || (y - 2) || '/a.doc' ELSE 'x.pdf' END AS source FROM i""")
def export_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, slug=_K, jsonPath="CASE WHEN k % 4 = 1 THEN concat('data/parsed/', cast(y - 1 as string), '/x.json') END", sourceWord="CASE WHEN k % 2 = 0 THEN concat('w/', cast(y - 2 as string), '/a.doc') END", sourcePdf="'x.pdf'")
    rows = rows.withColumn("sitePublication", F.struct(F.when(F.col("k") % 4 == 0, F.col("y")).alias("year")))
    return items_of(rows).select("slug", "year", F.col("sourcePath").alias("source"))
