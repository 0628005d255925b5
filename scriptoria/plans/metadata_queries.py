"""Titles, authors, paragraphs and enrichment over documents that are made from the orders' keys and dates; each oracle applies the rule in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import authors, labels, text
from scriptoria.operators import enrich as E
from scriptoria.operators import layout, normalize
from scriptoria.scratch import materialise

from .registering import query
from .rule_queries import _K, _M, _NAME, _NULL, _ORDERS, _Y, _cases, _orders, _pick

_ATTRIBUTED = "struct<name:string,slug:string,raw:string>"
_DATED = "struct<date:string,year:int,raw:string>"
_PUBLISHED = "struct<volume:int,issue:string,date:string,rawDate:string,raw:string>"


def _lines(x: Column) -> Column:
    """Lines of a text, split at bars; empty ones go."""
    return F.filter(F.split(x, r"\|"), lambda t: F.length(t) > 0)


_cases("translit_slug", text.name_slug, [
    (f"concat('Щука & Жук_ёж ', {_K})", "'schuka-and-zhuk-ezh-' || k"), (f"concat('Элизабет', {_K})", "'elizabet' || k"), (f"concat('Объём ', {_K})", "'obem-' || k"), (f"concat('ЦЧШ юя', {_K})", "'tschsh-yuya' || k")])
_cases("strip_quotes", text.unquoted, [(f"concat('«Жизнь ', {_K}, '»')", "'Жизнь ' || k"), (f"concat('Лекция «', {_K}, '»')", "x"), (f"concat(' \"a ', {_K}, '\" ')", "'a ' || k"), (f"concat('„', {_K}, '“')", "k::VARCHAR")])
_cases("json_string_array", lambda x: F.array_join(labels.strings_only(x), ";"), [
    (f"concat('[\"a', {_K}, '\", {{\"text\": \"b\"}}, ', {_M}, ', \"c\", null]')", "'a' || k || ';c'"), (f"concat('{{\"a\": ', {_K}, '}}')", "''"), ("'bad'", "''"), (f"concat('[\"', {_K}, '\"]')", "k::VARCHAR")])


def _author(x: Column) -> Column:
    k = F.col("k").cast("string")
    pearl = F.when(F.col("k") % 5 == 2, F.concat(F.lit("Том "), k, F.lit(" № 32 – Иисус Христос – 6 августа 1978 г.")))
    path = F.when(F.col("k") % 5 == 4, F.concat(F.lit("a/Лекция Эль Мории "), k, F.lit(".doc"))).otherwise("x.doc")
    found = authors.extract_author(_lines(x), x, path, pearl)
    return F.concat_ws("|", found["name"], found["slug"], found["raw"])


_cases("author_precedence", _author, [
    (f"concat('Лекция Марка Л. Профета|Далекий Бог ', {_K})", "'Марк Л. Профет|mark-l-profet|Лекция Марка Л. Профета'"),
    (f"concat({_NAME}, ' ', {_Y}, '|Элизабет Клэр Профет|Лекция «Приливы»|(часть 1)')", "'Элизабет Клэр Профет|elizabet-kler-profet|Элизабет Клэр Профет'"),
    (f"concat('Лекция Э. К. Профет ', {_K})", "'Иисус Христос|iisus-hristos|Том ' || k || ' № 32 – Иисус Христос – 6 августа 1978 г.'"), (f"concat('Текст ', {_K})", "''"),
    (f"concat('Текст ', {_K})", "'Эль Мория ' || k || '|el-moriya-' || k || '|Лекция Эль Мории ' || k")])
_PART = "concat('Часть ', cast(k % 9 + 1 as string))"
_cases("part_titles", lambda x: labels.part_title(_lines(x), F.when(F.col("k") % 4 == 1, F.concat(F.lit("Курс (часть "), F.col("k") % 9 + 1, F.lit(")"))).when(F.col("k") % 4 == 2, F.lit("Второй семинар"))), [
    (f"concat({_NAME}, ' ', {_Y}, '|Второй семинар|', {_PART})", "'Часть ' || (k % 9 + 1)"), (_PART, _NULL), (f"concat('a', {_K}, '|', {_PART})", "'Часть ' || (k % 9 + 1)"), (f"concat('Диктовка ', {_K})", _NULL)])


@query(f"""WITH {_ORDERS} SELECT k AS doc, 1 AS place, 'придуманным словом ' || k AS text FROM o UNION ALL SELECT k, 2, 'Второй абзац ' || k || '.' FROM o""")
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k").cast("string")
    line = lambda column, x, y, t: F.struct(F.lit(1).alias("page"), F.lit(column).alias("column"), F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(12.0).alias("height"), t.alias("text"))
    rows = F.array(line(0, 40.0, 200.0, F.lit("придуман-")), line(1, 340.0, 350.0, F.concat(F.lit("ным словом "), k)), line(1, 340.0, 300.0, F.concat(F.lit("Второй абзац "), k, F.lit("."))))
    lines = _orders(spark, sf_dir).select(k.alias("doc"), F.explode(rows).alias("l")).select("doc", "l.*")
    return layout.paragraphs(lines).select(F.col("doc").cast("long").alias("doc"), F.col("place").cast("int").alias("place"), "text")


def _inner(spark: SparkSession, sf_dir: str, title: str, header: str, kind: str = "'sermon'", author: Column | None = None) -> DataFrame:
    """One inner document of each order: a written table, so that the rules' plans hold columns and not what made them.

    Orders are dealt out first, at most 100,000 to a task: the rules cost far more than their rows' bytes, and a file of few row groups is few tasks.
    """
    orders = _orders(spark, sf_dir).select("k")
    width = max(spark.sparkContext.defaultParallelism, -(-orders.count() // 100_000))
    empty, unknown = F.array().cast("array<string>"), lambda kind: F.from_json(F.lit("{}"), kind)
    made = orders.repartition(width, "k").select(
        "k", F.col("k").cast("string").alias("slug"), F.lit(1).alias("position"), F.expr(title).alias("documentTitle"), F.expr(kind).alias("documentType"),
        (unknown(_ATTRIBUTED) if author is None else author.cast(_ATTRIBUTED)).alias("author"), unknown(_DATED).alias("creation"), unknown(_PUBLISHED).alias("publication"),
        _lines(F.expr(header)).alias("header"), empty.alias("footerLines"), empty.alias("bodyLines"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("rawLabel"))
    return materialise(made, "inner")


@query(f"""WITH {_ORDERS} SELECT k, CASE k % 5 WHEN 0 THEN 'Далекий Бог ' || k WHEN 2 THEN 'Проповедь о самоосуждении ' || k WHEN 3 THEN 'Лекция «Приливы ' || k || '» (Часть I)' WHEN 4 THEN 'Жизнь после смерти ' || k END AS title,
CASE k % 5 WHEN 0 THEN 'Марк Л. Профет' WHEN 3 THEN 'Элизабет Клэр Профет' END AS author, CASE k % 5 WHEN 0 THEN 'mark-l-profet' WHEN 3 THEN 'elizabet-kler-profet' END AS author_slug, k % 5 = 1 AS needs FROM o""")
def needs_enrichment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda name, slug, raw: F.struct(F.lit(name).alias("name"), F.lit(slug).alias("slug"), F.lit(raw).cast("string").alias("raw"))
    k = F.col("k") % 5
    author = F.when(k == 0, named("Марка Л. Профета", "marka-l-profeta", "Лекция Марка Л. Профета")).when(k == 3, named("Элизабет Клэр Профет", "elizabet-kler-profet", None)).otherwise(named(None, None, None).cast(_ATTRIBUTED))
    docs = _inner(
        spark, sf_dir, _pick([f"concat('Далекий Бог ', {_K})", "'(часть 1)'", _NULL, "'(часть 1)'", f"concat('«Жизнь после смерти ', {_K}, '»')"], "k"),
        _pick([f"concat('Лекция Марка Л. Профета|Далекий Бог ', {_K})", "'Жемчужины Мудрости'", f"concat('Проповедь Э. К. Профет о самоосуждении ', {_K})", f"concat('Элизабет Клэр Профет|Лекция «Приливы ', {_K}, '»|(часть 1)')", "''"], "k"),
        "CASE k % 5 WHEN 3 THEN 'lecture' ELSE 'sermon' END", author)
    split = normalize.with_needs_enrichment(docs)
    return split.select("k", F.col("readyTitle").alias("title"), F.col("readyAuthor.name").alias("author"), F.col("readyAuthor.slug").alias("author_slug"), F.col("needsEnrichment").alias("needs"))


@query(f"""WITH {_ORDERS} SELECT k, CASE k % 5 WHEN 0 THEN 'Настоящее имя лекции ' || k END AS title, CASE k % 5 WHEN 1 THEN 'Элизабет Клэр Профет' END AS author, CASE k % 5 WHEN 3 THEN k::INT END AS volume,
CASE k % 5 WHEN 3 THEN '1980-01-01' END AS date, ['changed', 'changed', 'same', 'changed', 'failed'][k % 5 + 1] AS outcome FROM o""")
def merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = f"concat('Том ', {_K}, ' № 10 – Кто-то – 1 января 1980 г.')"
    docs = _inner(spark, sf_dir, _NULL, f"CASE k % 5 WHEN 3 THEN {raw} ELSE '' END")
    claim = f"""concat('{{"publication": {{"volume": ', {_K}, ', "issue": "10", "date": "1980-01-01", "rawDate": "1 января 1980 г.", "raw": "', {raw}, '", "confidence": "high"}}}}')"""
    record = _pick([f"""concat('{{"documentTitle": "Настоящее имя лекции ', {_K}, '"}}')""", """'{"author": {"name": "Э. К. Профет", "raw": "Э. К. Профет", "confidence": "high"}}'""", claim, claim, _NULL], "k")
    records = docs.select("slug", "position", F.expr(record).alias("record")).where("record is not null")
    out = E.enrich(docs, E.table_provider(records))
    return out.select("k", F.col("documentTitle").alias("title"), F.col("author.name").alias("author"), F.col("publication.volume").alias("volume"), F.col("publication.date").alias("date"), "outcome")
