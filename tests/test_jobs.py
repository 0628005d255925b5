"""An archive from source files to exports."""

from __future__ import annotations

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from scriptoria import jobs
from scriptoria.operators import archive, catalog, convert, enrich, load, postings
from scriptoria.settings import Settings
from scriptoria.sources import archive_files, docx, parsed_json

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
LINES = ["Январь 2020", "Лекция Марка Л. Профета", "Далекий Бог", "Сегодня утром я хочу сказать вам совсем немного о мудрости и о свете, который не гаснет никогда в сердце.", "Ещё абзац.",
         "Проповедь Марка Л. Профета «Далекий Бог» была прочитана 1 февраля 1970 года.", "Лекция Элизабет Клэр Профет", "О трех царях", "Возлюбленные сердца, я пришел сказать вам очень многое сегодня."]


def package(lines):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>" + "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in lines) + "</w:body></w:document>")
        z.writestr("word/footer1.xml", f"<w:ftr {W}><w:p><w:r><w:t>7</w:t></w:r></w:p></w:ftr>")
    return out.getvalue()


@pytest.fixture(scope="module")
def settings(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    for slug in ("2020Q1-1", "2020Q1-2"):
        d = root / "sources" / "2020" / "Q1" / "word"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{slug}.docx").write_bytes(package(LINES))
    (root / "sources" / "2020" / "Q1" / "word" / "2020Q1-1.doc").write_bytes(b"\xd0\xcf\x11\xe0rest")
    return Settings.below(str(root))


def test_chain(spark, settings):
    assert {r["outcome"] for r in jobs.prepare(spark, settings).collect()} == {"would-copy"}
    missing = jobs.chain(spark, settings)
    assert missing.count() == 0
    cont, docs = jobs.tables(spark, settings)
    assert [(r["slug"], r["siteMonth"], r["documentsCount"], r["pages"]) for r in cont.orderBy("slug").collect()] == [("2020Q1-1", 1, 2, 7), ("2020Q1-2", 2, 2, 7)]
    assert all(r["n"] == 0 for r in load.problems(cont, docs).collect())
    row = docs.where("slug = '2020Q1-1' and position = 1").first()
    assert (row["documentTitle"], row["documentType"], row["authorSlug"], str(row["creationDate"]), row["paragraphsCount"]) == ("Далекий Бог", "sermon", "mark-l-profet", "1970-02-01", 2)
    assert row["description"].startswith("Сегодня утром")
    assert all(jobs.smoke(spark, settings).values())


def test_refresh_leaves_other_issues_alone(spark, tmp_path):
    for slug in ("2019Q1-1", "2020Q1-1", "2020Q1-2"):
        d = tmp_path / "sources" / slug[:4] / "Q1" / "word"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{slug}.docx").write_bytes(package([x.replace("2020", slug[:4]) for x in LINES]))
    s = Settings.below(str(tmp_path))
    every = ["2019Q1-1", "2020Q1-1", "2020Q1-2"]
    slugs = lambda df: sorted(r["slug"] for r in df.select("slug").distinct().collect())
    jobs.chain(spark, s)
    for chosen in ({"slug": "2020Q1-1"}, {"year": 2019}, {"year": 2020}):
        jobs.chain(spark, s, **chosen)
        assert slugs(jobs.parsed_issues(spark, s)) == every and jobs.parsed_issues(spark, s).count() == 3
        cont, docs = jobs.tables(spark, s)
        assert slugs(cont) == slugs(docs) == every
    assert len(list((tmp_path / "tables" / "generations").iterdir())) == 2


def test_catalog_of_loaded_tables(spark, settings):
    cont, docs = jobs.tables(spark, settings)
    items = catalog.catalog_items(cont, docs, catalog.Filters.of(authorSlug="mark-l-profet")).collect()
    assert [i["path"] for i in items] == ["/pearls/2020/2020Q1-1", "/pearls/2020/2020Q1-2"] and [len(i["documents"]) for i in items] == [1, 1]
    assert items[0]["documents"][0]["authorHref"] == "/?authorSlug=mark-l-profet" and items[0]["siteMonthLabel"] == "Январь 2020"
    offline = catalog.offline_items(cont, docs, catalog.Filters(authorSlug="mark-l-profet")).collect()
    assert [o["slug"] for o in offline] == ["2020Q1-2", "2020Q1-1"] and all(o["documentsCount"] == 2 and o["singleDocument"] is None for o in offline)
    index = load.index(spark, settings.tables)
    for q in ("мудрость", "мудрости", "мудростью", "о мудрости", '"о мудрости"', '"мудрости и о свете"'):
        stem = postings.matching(index, spark, q)
        assert {(r["slug"], r["position"]) for r in stem.collect()} == {("2020Q1-1", 1), ("2020Q1-2", 1)}, q
    for q in ("о", '"свете мудрости"', "мудрость -свет", "молитва"):
        assert postings.matching(index, spark, q, docs).isEmpty(), q
    listed = postings.found_catalog(cont, docs, index, catalog.Filters.of(q="мудрости", siteYear="2020")).collect()
    assert [r["slug"] for r in listed] == ["2020Q1-1", "2020Q1-2"] and all(r["documents"][0]["score"] > 0 for r in listed)
    assert postings.found_catalog(cont, docs, index, catalog.Filters.of(q="мудрости", siteYear="1999")).isEmpty()
    best = postings.ranked_documents(cont, docs, index, catalog.Filters.of(q="Профета or мудрости")).collect()
    assert [(r["slug"], r["position"]) for r in best] == [("2020Q1-1", 1), ("2020Q1-2", 1), ("2020Q1-1", 2), ("2020Q1-2", 2)]
    assert best[0]["score"] == best[1]["score"] > best[2]["score"] == best[3]["score"]
    assert catalog.catalog(cont, docs, catalog.Filters(), stem.where("slug = '2020Q1-1'")).count() == 1


def test_search_job(spark, settings):
    best = jobs.search_catalog(spark, settings, "мудростью -царях", year="2020", author="mark-l-profet").collect()
    assert [(r["slug"], r["position"], r["documentTitle"]) for r in best] == [("2020Q1-1", 1, "Далекий Бог"), ("2020Q1-2", 1, "Далекий Бог")] and best[0]["score"] > 0
    assert jobs.search_catalog(spark, settings, "мудростью", kind="lecture").isEmpty()


def test_update_parses_what_has_changed(spark, tmp_path):
    d = tmp_path / "sources" / "2020" / "Q1" / "word"
    d.mkdir(parents=True)
    (d / "2020Q1-1.docx").write_bytes(package(LINES))
    s = Settings.below(str(tmp_path))
    assert [r["state"] for r in jobs.update(spark, s).collect()] == ["added"]
    assert [r["state"] for r in jobs.changes(spark, s).collect()] == ["same"]
    stamp = (tmp_path / "downloads/2020/2020Q1-1.txt").stat().st_mtime_ns
    (d / "2020Q1-2.docx").write_bytes(package(LINES))
    assert sorted((r["state"], r["newPath"]) for r in jobs.update(spark, s).collect()) == [("added", "2020/Q1/word/2020Q1-2.docx"), ("same", "2020/Q1/word/2020Q1-1.docx")]
    assert jobs.tables(spark, s)[0].count() == 2 and (tmp_path / "downloads/2020/2020Q1-2.txt").exists()
    assert (tmp_path / "downloads/2020/2020Q1-1.txt").stat().st_mtime_ns == stamp
    (d / "2020Q1-2.docx").unlink()
    assert sorted(r["state"] for r in jobs.update(spark, s).collect()) == ["gone", "same"] and [r["state"] for r in jobs.changes(spark, s).collect()] == ["same"]
    found = jobs.write_report(jobs.audit(spark, s), s, "audit")
    assert spark.read.json(found).first()["filesCount"] == 1


def test_exports(spark, settings, tmp_path):
    import pathlib

    text = pathlib.Path(settings.exports, "downloads/2020/2020Q1-1.txt").read_text()
    assert text.startswith("Жемчужины Мудрости. Январь 2020\n\nЯнварь 2020\n\n\n\nДалекий Бог\n\n") and text.endswith("\n\n")
    with zipfile.ZipFile(pathlib.Path(settings.exports, "downloads/2020/2020Q1-1.epub")) as z:
        assert z.namelist()[0] == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
    again = docx.parse_package(pathlib.Path(settings.exports, "downloads/2020/2020Q1-1.docx").read_bytes())["body"]
    assert again[0]["isBold"] and "Далекий Бог" in [p["text"] for p in again]


def test_enrichment_and_archive(spark, settings):
    out = jobs.enrich_issues(spark, settings)
    assert {r["outcome"] for r in out.collect()} <= {"ready", "normalised", "failed"}
    with pytest.raises(Exception, match="not available"):
        def banned(asked):
            return asked.select("slug", "position", F.lit(None).cast("string").alias("record"), F.lit(403).alias("status"), F.lit("403 Forbidden").alias("error"))

        enrich.enrich(spark.createDataFrame([("s", 1, None, "sermon", (None,) * 3, (None,) * 3, (None,) * 5, [], [], [], None, None)],
            "slug string, position int, documentTitle string, documentType string, author struct<name:string,slug:string,raw:string>, creation struct<date:string,year:int,raw:string>, "
            "publication struct<volume:int,issue:string,date:string,rawDate:string,raw:string>, header array<string>, footerLines array<string>, bodyLines array<string>, label string, rawLabel string"), banned).collect()  # fmt: skip
    assert jobs.audit(spark, settings).first()["filesCount"] == 3
    listing = archive_files.read_listing(spark, settings.sources)
    assert listing.count() == 3 and archive.resolve_source(listing, "2020Q1-1").first()["extension"] == ".docx"
    with pytest.raises(LookupError):
        archive.resolve_source(listing, "2020Q1-3")
    with pytest.raises(ValueError):
        archive.resolve_source(listing, "nonsense")
    with pytest.raises(convert.ConversionError):
        convert.NoConverter().convert(b"", "a.doc", "docx")


def test_parsed_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"slug": "2020Q1-1", "title": "T",\n "sitePublication": {"year": 2020}, "documents": []}')
    (tmp_path / "b_OLD.json").write_text("{}")
    assert [r["slug"] for r in parsed_json.issues_of(spark, str(tmp_path), year=2020).collect()] == ["2020Q1-1"]
    with pytest.raises(LookupError, match="2020"):
        parsed_json.issues_of(spark, str(tmp_path), year=1999)
    (tmp_path / "c.json").write_text("{broken")
    with pytest.raises(Exception):  # noqa: B017
        parsed_json.read_issues(spark, str(tmp_path)).collect()
    assert parsed_json.read_issues(spark, str(tmp_path), strict=False).count() == 2
