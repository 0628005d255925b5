"""Rules of lines, dates, authors, titles, publications and labels on single examples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scriptoria.functions import authors, dates, labels, publication, stemming, text, titles
from scriptoria.operators import catalog, search, segment



def value(spark, column, schema, *row):
    out = spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]
    return out.asDict(True) if hasattr(out, "asDict") else out


@pytest.mark.parametrize(("line", "day"), [
    ("была прочитана 1 февраля 1970 года в Колорадо", "1970-02-01"), ("прочитана 3 января 1998 года в отеле", "1998-01-03"), ("31 февраля 1970 года", None), ("Здесь нет даты", None), ("2 1 мая 202 6 г.", "2026-05-21"), (None, None),
])
def test_russian_date(spark, line, day):
    assert value(spark, dates.russian_date(F.col("x")), "x string", line) == day


@pytest.mark.parametrize(("lines", "kind"), [
    ("Лекция Марка Л. Профета\nДалекий Бог\nПроповедь была прочитана", "sermon"), ("Лекция о трех царях", "lecture"), ("Диктовка Эль Мории", "dictation"), ("Курс лекций по алхимии", "lectureCourse"), ("Учения о семи лучах", "teaching"),
    ("Просто текст", "material"), ("a\nОткрывающий призыв\nb", "prayer"),
])
def test_document_type(spark, lines, kind):
    assert value(spark, publication.document_type(F.col("x")), "x string", lines) == kind


def test_creation(spark):
    path = "../src/2020/Q1/word/2020Q1-1.doc"
    footer = "Проповедь была прочитана 1 февраля 1970 года."
    made = publication.creation(F.col("x"), F.col("p"))
    assert value(spark, made, "x string, p string", footer, path) == {"date": "1970-02-01", "year": 1970, "raw": footer, "yearSource": "text"}
    assert value(spark, made, "x string, p string", "", path) == {"date": None, "year": 2020, "raw": None, "yearSource": "path"}


@pytest.mark.parametrize(("header", "name", "slug", "raw"), [
    (["Лекция Марка Л. Профета", "Далекий Бог"], "Марк Л. Профет", "mark-l-profet", "Лекция Марка Л. Профета"),
    (["Лекция Элизабет Клэр Профет", "О трех царях"], "Элизабет Клэр Профет", "elizabet-kler-profet", "Лекция Элизабет Клэр Профет"),
    (["Октябрь 2019", "Элизабет Клэр Профет", "Лекция «Приливы»", "(часть 1)"], "Элизабет Клэр Профет", "elizabet-kler-profet", "Элизабет Клэр Профет"),
    ([], None, None, None),
])
def test_author(spark, header, name, slug, raw):
    made = authors.extract_author(F.col("h"), F.array_join("h", "\n"), F.lit("x.doc"), F.lit(None).cast("string"))
    assert value(spark, made, "h array<string>", header) == {"name": name, "slug": slug, "raw": raw}


def paragraphs(lines):
    return [(x, None, None, None, None, None) for x in lines]


@pytest.mark.parametrize(("header", "body", "title"), [
    (["Январь 2020", "Лекция Марка Л. Профета", "Далекий Бог"], ["Сегодня утром я хочу сказать совсем немного."], "Далекий Бог"),
    (["Лекция Элизабет Клэр Профет", "О трех царях"], ["Сейчас я хочу представить вашему вниманию лекцию."], "О трех царях"),
    (["Октябрь 2019", "Элизабет Клэр Профет", "Лекция «Приливы»", "(часть 1)"], ["ПРИЗЫВ", "Сегодня мы начнем."], "Лекция «Приливы» (Часть 1)"),
    (["Элизабет Клэр Профет", "Лекция № 2 из серии «О смерти, развоплощенных", "и злонамеренных духах» (1990 г.)"], ["(часть 1)", "Текст."], "Лекция № 2 из серии «О смерти, развоплощенных и злонамеренных духах» (1990 г.) (Часть 1)"),
    ([], [], None),
])
def test_title(spark, header, body, title):
    kind = f"array<{segment.PARAGRAPH}>"
    df = spark.createDataFrame([(paragraphs(header), paragraphs(body), [])], f"h {kind}, b {kind}, f {kind}")
    assert titles.with_title(df, "h", "b", "f").first()["documentTitle"] == title


@pytest.mark.parametrize(("raw", "volume", "issue", "day", "raw_date"), [
    ("Том 21 № 32 – Иисус Христос – 6 августа 1978 г.", 21, "32", "1978-08-06", "6 августа 1978 г."), ("Том. 52 № 17 – возлюбленный Годфри – 1 сентября 2009 г.", 52, "17", "2009-09-01", "1 сентября 2009 г."),
    ("Просто текст", None, None, None, None),
])
def test_publication_line(spark, raw, volume, issue, day, raw_date):
    got = value(spark, publication.publication_line(F.col("h")), "h array<string>", [raw])
    assert got == {"volume": volume, "issue": issue, "date": day, "rawDate": raw_date, "raw": raw if volume else None}


def test_source_path(spark):
    path = "../src/2020/Q1/word/2020Q1-1.doc"
    assert value(spark, dates.source_publication(F.col("p")), "p string", path) == {"year": 2020, "quarter": 1, "month": 1, "rawLabel": "январь 2020"}
    pub = publication.issue_of(F.col("p"), F.array().cast("array<string>"))
    assert value(spark, pub, "p string", path) == {"label": "Январь 2020", "rawLabel": "январь 2020", "year": 2020, "month": 1, "months": ["2020-01"], "sortDate": "2020-01-01"}
    assert value(spark, publication.issue_slug(F.col("p"), pub), "p string", path) == "2020Q1-1"


@pytest.mark.parametrize(("header", "title", "part"), [
    (["Январь 2020", "Второй семинар", "Часть II"], None, "Часть II"), (["Часть VII"], "Курс лекций (Часть VII)", None), (["Часть II"], "Второй семинар", "Часть II"), (["Диктовка"], "Диктовка", None), ([], None, None),
])
def test_part_title(spark, header, title, part):
    assert value(spark, labels.part_title(F.col("h"), F.col("t")), "h array<string>, t string", header, title) == part


@pytest.mark.parametrize(("json", "items"), [('["a", {"text": "b"}, 3, "c", null]', ["a", "c"]), ('{"a": 1}', []), ("bad", []), (None, [])])
def test_strings_only(spark, json, items):
    assert value(spark, labels.strings_only(F.col("j")), "j string", json) == items


@pytest.mark.parametrize(("raw", "number"), [("2e3", 2000), (" 2011 ", 2011), ("0x7db", 2011), ("-5", None), ("1.5", None), ("", None), (None, None), ("abc", None)])
def test_positive_integer(raw, number):
    assert catalog.positive_integer(raw) == number


def test_filter_links():
    f = catalog.Filters.of(siteYear="2011", authorSlug=" a b ", q=["x", "y"], documentType="  ")
    assert f == catalog.Filters(2011, "a b", None, "x")
    assert labels.filter_href(f.links(), labels.CATALOG_KEYS) == "/?siteYear=2011&authorSlug=a+b&q=x"
    assert [c["href"] for c in catalog.active_filters(f)] == ["/?authorSlug=a+b&q=x", "/?siteYear=2011&q=x", "/?siteYear=2011&authorSlug=a+b"]


def test_search_parser_never_fails():
    assert search.parse('a "b c" -d or e') == [[search.Clause(("a",)), search.Clause(("b", "c")), search.Clause(("d",), True)], [search.Clause(("e",))]]
    assert search.parse('"" - or') == [] and search.parse('"open') == [[search.Clause(("open",))]]


@pytest.mark.parametrize(("word", "stem"), [("мудрости", "мудрост"), ("учения", "учен"), ("лекциями", "лекц"), ("красивейший", "красив"), ("молиться", "мол"), ("в", "в")])
def test_stems(word, stem):
    assert stemming.stem(word) == stem


def test_text_functions(spark):
    assert value(spark, text.slug_part(F.col("x")), "x string", "A & B__c!") == "a-and-b-c"
    assert value(spark, text.unquoted(F.col("x")), "x string", " «Жизнь» ") == "Жизнь"
    assert value(spark, text.extension(F.col("x")), "x string", "a/b.tar.GZ") == ".gz"
    assert value(spark, text.swapped_doc(F.col("x")), "x string", "a.docx") == "a.doc"
    assert value(spark, text.path_key(F.col("x")), "x string", "ТРЕТИЙ") == "третий"
