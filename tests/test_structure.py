"""Invariants of segmentation and layout, and the archive's naming."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import functions as F

from scriptoria.functions import lines as L
from scriptoria.operators import archive, enrich, layout, segment
from scriptoria.streaming import arrivals

KINDS = [
    "Январь 2020", "17", "Лекция о свете", "Том 3 № 4 – Имя – 6 августа 1978 г.", "Диктовка Имени была дана 1 мая 1980 года.", "Короткая строка", "Обычный текст абзаца, который длиннее сорока пяти символов.", "Жемчужины Мудрости", "и далее",
]


def test_segmentation_keeps_every_line_once(spark):
    rng = random.Random(7)
    issues = [(str(i), "src/2020/Q1/word/2020Q1-1.doc", [(x, None, None, None, None, None) for x in rng.choices(KINDS, k=rng.randint(0, 30))]) for i in range(60)]
    df = spark.createDataFrame(issues, f"issueId string, sourcePath string, paragraphs array<{segment.PARAGRAPH}>")
    drop = lambda p: L.is_page_number(p["text"]) | L.is_running_line(p["text"])
    rows = segment.segment(df).select("issueId", "paragraphs", "segments", segment.body_start(F.col("paragraphs")).alias("start"), F.transform("paragraphs", drop).alias("drop"), F.transform("paragraphs", lambda p: L.is_page_number(p["text"])).alias("number")).collect()
    for r in rows:
        texts = [p["text"] for p in r["paragraphs"]]
        kept = [t for i, t in enumerate(texts) if not (r["number"][i] if i < r["start"] else r["drop"][i])]
        placed = [p["text"] for s in r["segments"] for part in ("header", "body", "footer") for p in s[part]]
        assert sorted(placed) == sorted(kept)
        assert all(s["header"] or s["body"] or s["footer"] for s in r["segments"])
        body = [p["text"] for s in r["segments"] for p in s["body"]]
        it = iter(texts)
        assert all(x in it for x in body)  # reading order


def test_lines_join_their_anchor():
    page = pd.DataFrame([("d", 1, 0, 10.0, 100.0, 4.0, "b"), ("d", 1, 0, 1.0, 98.0, 4.0, "a"), ("d", 1, 0, 1.0, 96.0, 4.0, "c"), ("d", 1, 0, 1.0, 80.0, 4.0, "e")], columns=["doc", "page", "column", "x", "y", "height", "text"])
    assert list(layout.cluster(page)["text"]) == ["a b", "c", "e"]


def test_names_are_unique(spark):
    files = archive.listing(spark.createDataFrame([(f"2020/Q1/{d}/{n}",) for d in ("a", "b", "c") for n in ("Январь 2020.doc", "январь 2020.DOC", "x.doc")], "relativePath string"))
    paths = [r["newPath"] for r in archive.source_map(files).collect()]
    assert len({p.lower() for p in paths}) == len(paths) == 9 and "2020/Q1/word/2020Q1-1.doc" in paths


def test_budget_with_and_without_blocks(spark):
    rows = spark.createDataFrame([(i, i // 10, i % 3 == 0) for i in range(100)], "k int, b int, needs boolean")
    plain = {r["k"] for r in enrich.budgeted(rows, "needs", ["k"], 7).where("inBudget and needs").collect()}
    blocked = {r["k"] for r in enrich.budgeted(rows, "needs", ["k"], 7, block="b").where("inBudget and needs").collect()}
    assert plain == blocked == {0, 3, 6, 9, 12, 15, 18}
    assert enrich.budgeted(rows, "needs", ["k"], 0).where("inBudget and needs").count() == 0
    assert enrich.budgeted(rows.where("false"), "needs", ["k"], 5).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, v int, x string")
    second = spark.createDataFrame([(1, 2, "c"), (3, 1, "d"), (2, 0, "old")], "k int, v int, x string")
    first.write.parquet(source)
    stream = lambda: spark.readStream.schema(first.schema).parquet(source)
    arrivals.run_available(stream(), table, f"{tmp_path}/checkpoint", ["k"], ["v"])
    second.write.mode("append").parquet(source)
    arrivals.run_available(stream(), table, f"{tmp_path}/checkpoint", ["k"], ["v"])
    assert sorted(map(tuple, arrivals.current(spark, table).collect())) == [(1, 2, "c"), (2, 1, "b"), (3, 1, "d")]


def test_book_files_read_back():
    import io
    import xml.etree.ElementTree as ET
    import zipfile

    from scriptoria.operators import bookfiles
    from scriptoria.sources import docx

    issue = {"slug": "2020Q1-1", "year": "2020", "title": "A & <B>\x01", "subtitle": ["Май 2020"], "documents": [{"title": "Первый", "header": ["h"], "body": [" two  spaces ", "x"], "footer": None}, {"title": "Второй", "header": [], "body": ["y"], "footer": ["f"]}]}
    words = [p["text"] for p in docx.parse_package(bookfiles.docx(issue))["body"]]
    assert [" ".join(w.split()) for w in words] == ["A & <B>", "Май 2020", "Первый", "h", "two spaces", "x", "Второй", "y", "f"]
    made = bookfiles.epub(issue, "2020-01-01T00:00:00Z")
    assert made == bookfiles.epub(issue, "2020-01-01T00:00:00Z")
    with zipfile.ZipFile(io.BytesIO(made)) as z:
        assert z.namelist()[0] == "mimetype" and z.read("mimetype") == b"application/epub+zip" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
        parts = {n: ET.fromstring(z.read(n)) for n in z.namelist()[1:]}
    opf, nav, text = (parts[f"OEBPS/{n}"] for n in ("content.opf", "nav.xhtml", "text.xhtml"))
    ids = {x.get("id") for x in text.iter() if x.get("id")}
    links = [x.get("href") for x in nav.iter(f"{{{bookfiles.XHTML}}}a")]
    assert links == ["text.xhtml#d1", "text.xhtml#d2"] and ids == {"d1", "d2"}
    assert opf.get("unique-identifier") == "issue" and [x.text for x in opf.iter(f"{{{bookfiles.DC}}}identifier")] == ["urn:x-issue:2020:2020Q1-1"]
    assert {x.get("href") for x in opf.iter(f"{{{bookfiles.OPF}}}item")} == {"text.xhtml", "nav.xhtml"}
    assert [x.text for x in text.iter(f"{{{bookfiles.XHTML}}}p")] == ["Май 2020", "h", " two  spaces ", "x", "y", "f"]
