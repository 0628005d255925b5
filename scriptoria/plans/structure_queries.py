"""Document structure, normalisation and enrichment: queries over the driver's tables and over inline rows."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.operators import enrich as E
from scriptoria.operators import evidence, layout, normalize, segment
from scriptoria.sources import docx

from .registering import query
from .roles import table

_P = segment.PARAGRAPH


def _paragraphs(*lines: str) -> list:
    return [(x, None, None, None, None, None) for x in lines]


_ISSUE = [
    "Январь 2020", "Лекция Марка Л. Профета", "Далекий Бог", "Сегодня утром я хочу сказать совсем немного.", "12", "Ещё абзац текста.",
    "Проповедь Марка Л. Профета «Далекий Бог» была прочитана 1 февраля 1970 года в Колорадо.", "Лекция Элизабет Клэр Профет", "О трех царях", "Том 21 № 32 – Иисус Христос – 6 августа 1978 г.", "Возлюбленные сердца, я пришел.",
]


@query("""SELECT * FROM (VALUES (1, 'Далекий Бог', 'header', 'sermon', 'Марк Л. Профет', '1970-02-01', 3, 2, 1), (2, 'О трех царях', 'header', 'lecture', 'Иисус Христос', NULL, 3, 1, 0)) v(position, title, source, kind, author, created, headers, bodies, footers)""")
def segment_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    issue = spark.createDataFrame([("i", "src/2020/Q1/word/2020Q1-1.doc", _paragraphs(*_ISSUE))], f"issueId string, sourcePath string, paragraphs array<{_P}>")
    docs = segment.inner_documents(segment.segment(issue))
    size = lambda c: F.size(f"parts.{c}").alias
    return docs.select("position", F.col("documentTitle").alias("title"), F.col("titleSource").alias("source"), F.col("documentType").alias("kind"), F.col("author.name").alias("author"), F.col("creation.date").alias("created"),
                       size("header")("headers"), size("body")("bodies"), size("footer")("footers"))


@query("""WITH s AS (SELECT *, sum(CASE WHEN role = 'system' OR turn = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS seg FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS turn, role, text FROM conversations))
SELECT conv_id, seg::BIGINT AS island, string_agg(role, '>' ORDER BY turn) AS roles FROM s GROUP BY 1, 2""")
def conversation_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "conversations").withColumn("turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1)
    cut = layout.islands(rows, ["conv_id"], ["turn"], (F.col("role") == "system") | (F.col("turn") == 0), "role")
    return cut.select("conv_id", F.col("island").cast("long").alias("island"), F.array_join("parts", ">").alias("roles"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents), k AS (SELECT * FROM l WHERE line <> ''),
s AS (SELECT *, lag(line) OVER w AS prev FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
f AS (SELECT *, CASE WHEN prev IS NULL OR NOT (regexp_matches(line, '^[а-яёa-z]') AND (prev LIKE '%-' OR NOT regexp_matches(prev, '[.!?…»][»"'')]*\s*$'))) THEN 1 ELSE 0 END AS starts FROM s),
i AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY place) AS island, lead(starts) OVER (PARTITION BY doc_id ORDER BY place) AS nxt FROM f)
SELECT doc_id, island::BIGINT AS place, md5(string_agg(CASE WHEN starts = 1 OR prev LIKE '%-' THEN '' ELSE ' ' END || CASE WHEN nxt = 0 AND line LIKE '%-' THEN left(line, length(line) - 1) ELSE line END, '' ORDER BY place)) AS digest FROM i GROUP BY 1, 2""")
def merge_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("place", "text")).where("text <> ''")
    return layout.merge_broken(lines).select(F.col("doc").alias("doc_id"), F.col("place").cast("long").alias("place"), F.md5("text").alias("digest"))


@query("""WITH g AS (SELECT l_suppkey, l_extendedprice AS x, lag(l_extendedprice) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS b FROM lineitem)
SELECT l_suppkey, round(max(x - b), 4) AS gap, round(arg_max(b + (x - b) / 2, (x - b, -x)), 4) AS mid FROM g WHERE b IS NOT NULL GROUP BY 1""")
def column_gap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.widest_gap(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice")
    return found.select("l_suppkey", F.round("gap", 4).alias("gap"), F.round("mid", 4).alias("mid"))


@query("""WITH i AS (SELECT l_suppkey AS page, CASE WHEN l_extendedprice >= 30000 THEN 1 ELSE 0 END AS col, l_quantity AS y, l_extendedprice AS x FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY col, y DESC, x) AS place FROM i)
SELECT page, col AS "column", min(place)::INT AS first, max(place)::INT AS last, round(arg_min(x, place), 4) AS x FROM o GROUP BY 1, 2""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc"), F.col("l_suppkey").alias("page"), F.col("l_quantity").alias("y"), F.col("l_extendedprice").alias("x"))
    pages = items.select("doc", "page").distinct().withColumns({"layout": F.lit("two-column"), "splitX": F.lit(30000.0)})
    placed = layout.reading_order(items, pages)
    return placed.groupBy("page", "column").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.round(F.min_by("x", "place"), 4).alias("x"))


@query()
def line_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("doc"), F.col("p_size").alias("page"), F.lit(0).alias("column"), (F.col("p_partkey") % 97).cast("double").alias("x"), (F.col("p_retailprice") % 50).alias("y"), F.lit(4.0).alias("height"), F.col("p_name").alias("text"))
    return layout.page_lines(items)


@query("SELECT * FROM (VALUES ('d', 1, 'two-column'), ('d', 2, 'single-column')) v(doc, page, layout)")
def page_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = [("d", 1, 600.0, 400.0, x, 350.0 - 10 * i, 20.0, 10.0, f"{side}-{i}") for i in range(30) for x, side in ((60.0, "left"), (360.0, "right"))]
    tall = [("d", 2, 400.0, 700.0, 50.0, 700.0 - 20 * i, 20.0, 10.0, f"line-{i}") for i in range(25)]
    items = spark.createDataFrame(wide + tall, "doc string, page int, pageWidth double, pageHeight double, x double, y double, width double, height double, text string")
    return layout.page_layouts(layout.clean_items(items)).select("doc", "page", "layout")


@query()
def pdf_items_to_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("src/2020/Q1/word/2020Q1-2.pdf", 1, 400.0, 700.0, 50.0, 650.0 - 40 * i, 20.0, 10.0, t) for i, t in enumerate(_ISSUE)]
    items = layout.clean_items(spark.createDataFrame(rows, "doc string, page int, pageWidth double, pageHeight double, x double, y double, width double, height double, text string"))
    pages = layout.page_layouts(items)
    lines = layout.paragraphs(layout.page_lines(layout.reading_order(items, pages)))
    issue = segment.build_issues(docx.issues_from_lines(lines, layout.document_layout(pages)))
    return issue.select("slug", "title", "documentsCount", F.col("sitePublication.sortDate").alias("sortDate"), F.col("meta.layout").alias("layout"))


def sample_docx() -> bytes:
    """A small package: a styled heading, a bold run, a footer with a page number."""
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    styles = f'<w:styles {w}><w:style w:styleId="H"><w:rPr><w:b/><w:sz w:val="32"/></w:rPr></w:style></w:styles>'
    body = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="H"/></w:pPr><w:r><w:t>A &amp; B</w:t></w:r></w:p><w:p><w:r><w:rPr><w:b w:val="0"/></w:rPr><w:t>plain</w:t><w:tab/><w:t>text</w:t></w:r><w:r><w:rPr><w:b/></w:rPr><w:t> x</w:t></w:r></w:p><w:p/></w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", body)
        z.writestr("word/styles.xml", styles)
        z.writestr("word/footer1.xml", f"<w:ftr {w}><w:p><w:r><w:t>12</w:t></w:r></w:p></w:ftr>")
    return out.getvalue()


@query("""SELECT * FROM (VALUES ('a.docx', 'A & B|plain text x', 'true|false', '16.0|-', 12, NULL), ('b.docx', '', '', '', 0, 'part not found: word/document.xml')) v(path, body, bold, sizes, pages, error)""")
def docx_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as z:
        z.writestr("x", "")
    files = spark.createDataFrame([("a.docx", bytearray(sample_docx())), ("b.docx", bytearray(empty.getvalue()))], "path string, content binary")
    joined = lambda f: F.array_join(F.transform("body", f), "|")
    return docx.parse(files).select(
        "path", joined(lambda p: p["text"]).alias("body"), joined(lambda p: p["isBold"].cast("string")).alias("bold"), joined(lambda p: F.coalesce(p["maxFontSize"].cast("string"), F.lit("-"))).alias("sizes"),
        segment.page_count(F.transform("footers", lambda p: p["text"])).alias("pages"), "error")


@query("""WITH j AS (SELECT d.doc_id, d.source, d.lang, CASE WHEN l.quality = 1 THEN 'en' ELSE d.lang END AS new_lang, l.doc_id IS NOT NULL AS asked FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT count_if(asked)::BIGINT AS asked, count_if(NOT asked)::BIGINT AS ready, count_if(lang IS DISTINCT FROM new_lang)::BIGINT AS changed, count(DISTINCT CASE WHEN lang IS DISTINCT FROM new_lang THEN source END)::BIGINT AS changed_issues FROM j""")
def changed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels_ = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = table(spark, sf_dir, "documents").join(labels_, "doc_id", "left").withColumn("new_lang", F.when(F.col("quality") == 1, "en").otherwise(F.col("lang")))
    outcome = F.when(normalize.changed("lang", "new_lang"), "changed").when(F.col("quality").isNotNull(), "same").otherwise("ready")
    return E.run_report(rows.select(F.col("source").alias("slug"), outcome.alias("outcome")))


@query("""WITH n AS (SELECT d.doc_id, l.doc_id IS NULL AS needs FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), r AS (SELECT *, sum(needs::INT) OVER (ORDER BY doc_id) AS k FROM n)
SELECT doc_id, needs, NOT needs OR k <= 100 AS inBudget FROM r""")
def budgeted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("known")).distinct()
    rows = table(spark, sf_dir, "documents").join(known, "doc_id", "left").select("doc_id", F.col("known").isNull().alias("needs"))
    return E.budgeted(rows, "needs", ["doc_id"], 100)


@query("SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def evidence_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.claims_in_texts(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")
