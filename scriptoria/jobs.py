"""Jobs of an archive, also as commands: ``python -m scriptoria.jobs <command> --root DIR [--slug S] [--year Y] ...``.

prepare, parse-word, parse-pdf, audit, map, plan-moves, load, search, changes, update, export, verify, enrich, smoke; ``year`` and ``refresh``
run the chain parse, load, export, verify for a year or an issue.  Each job is a function of a session and settings.  audit, map, plan-moves and
enrich write their result as JSON lines with ``--write``, below ``reports`` of the root.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions.dates import year_in_path
from scriptoria.functions.labels import parsed_path
from scriptoria.functions.text import stem
from scriptoria.operators import archive, catalog, enrich, exports, freshness, layout, load, merged, postings, segment
from scriptoria.scratch import materialise
from scriptoria.settings import Settings
from scriptoria.sources import archive_files, docx, parsed_json


def _chosen(df: DataFrame, path: str, year: int | None, slug: str | None, quarter: int | None = None, file: str | None = None) -> DataFrame:
    out = df if year is None else df.where(year_in_path(F.col(path)) == year)
    out = out if quarter is None else out.where(F.col(path).rlike(rf"(?i)(^|/)Q{quarter}(/|$)|(^|/)\d{{4}}Q{quarter}-|(^|/){quarter}-й квартал(/|$)"))
    out = out if file is None else out.where((F.col(path) == file) | F.endswith(path, F.lit(f"/{file}")))
    return out if slug is None else out.where(stem(F.col(path)) == slug)


def prepare(spark: SparkSession, s: Settings, year: int | None = None, slug: str | None = None, dry_run: bool = True, force: bool = False) -> DataFrame:
    """What a preparation does with each word source (nothing is copied or converted here)."""
    sources = archive.preferred_word_sources(archive.word_sources(archive_files.read_listing(spark, s.sources)))
    outputs = archive_files.read_listing(spark, s.prepared) if _exists(spark, s.prepared) else sources.limit(0)
    return archive.prepare_outcome(_chosen(sources, "relativePath", year, slug), outputs, dry_run, force)


def parse_word(spark: SparkSession, s: Settings, year: int | None = None, slug: str | None = None, overrides: DataFrame | None = None, quarter: int | None = None, file: str | None = None) -> DataFrame:
    """Parsed issues of all DOCX packages, or of those that a year, quarter, file or slug names; written below the parsed root."""
    packages = _chosen(docx.read_docx(spark, s.sources, strict=True), "path", year, slug, quarter, file)
    return _write_parsed(segment.build_issues(docx.issues_from_docx(packages), overrides), s)


def parse_pdf(spark: SparkSession, s: Settings, items: DataFrame) -> DataFrame:
    """Parsed issues from positioned items (see ``layout``)."""
    tidy = layout.clean_items(items)
    pages = layout.page_layouts(tidy)
    lines = layout.paragraphs(layout.page_lines(layout.reading_order(tidy, pages)))
    return _write_parsed(segment.build_issues(docx.issues_from_lines(lines, layout.document_layout(pages))), s)


def parse_pdf_items(spark: SparkSession, s: Settings, items: str) -> DataFrame:
    """``parse_pdf`` of positioned items in a Parquet table (no library here decodes PDF files)."""
    return parse_pdf(spark, s, spark.read.parquet(items))


def search_catalog(spark: SparkSession, s: Settings, q: str, year: str | None = None, author: str | None = None, kind: str | None = None) -> DataFrame:
    """Documents that match a text query under the catalog's facets, best first, from the index that the last load wrote."""
    cont, docs = tables(spark, s)
    filters = catalog.Filters.of(siteYear=year, authorSlug=author, documentType=kind, q=q)
    found = postings.ranked_documents(cont, docs, load.index(spark, s.tables), filters)
    return found.join(docs.select("slug", "position", "documentTitle", "authorName"), ["slug", "position"]).orderBy(F.desc("score"), "slug", "position")


def _snapshot(s: Settings) -> str:
    return f"{s.tables}/snapshot"


def changes(spark: SparkSession, s: Settings) -> DataFrame:
    """What has changed among the sources since the last ``update`` (everything is added before the first)."""
    now = archive_files.read_listing(spark, s.sources).select("relativePath", "sha256", "mtime")
    was = merged.read(spark, _snapshot(s))
    return freshness.listing_changes(now.limit(0) if was is None else was.where("present").select(*now.columns), now)


def update(spark: SparkSession, s: Settings) -> DataFrame:
    """Parse the packages that were added, changed or moved since the last update, load and export these; returns the changes."""
    found = materialise(changes(spark, s), "changes")
    paths = [r[0] for r in freshness.to_process(found).where("lower(newPath) like '%.docx'").collect()]  # names of the arrived files
    if paths:
        packages = docx.read_docx(spark, s.sources, strict=True)
        arrived = spark.createDataFrame([(p,) for p in paths], "_new string")
        packages = packages.join(F.broadcast(arrived), F.endswith("path", F.concat(F.lit("/"), "_new")) | (F.col("path") == F.col("_new")), "left_semi")
        parsed = segment.build_issues(docx.issues_from_docx(packages))
        slugs = [r[0] for r in parsed.select("slug").distinct().collect()]
        _write_parsed(parsed, s)
        load_tables(spark, s)
        for slug in slugs:
            export_issues(spark, s, slug=slug).write.format("noop").mode("overwrite").save()
    now = archive_files.read_listing(spark, s.sources).select("relativePath", "sha256", "mtime", F.lit(True).alias("present"))
    was = merged.read(spark, _snapshot(s))
    if was is not None:  # files that are gone stay as rows without a digest
        gone = was.join(now.select("relativePath"), "relativePath", "left_anti").withColumn("present", F.lit(False))
        now = now.unionByName(gone.select(*now.columns))
    merged.merge(materialise(now, "listing"), _snapshot(s), ["relativePath"])
    return found


def _write_parsed(issues: DataFrame, s: Settings) -> DataFrame:
    paragraph = F.transform
    inner = paragraph("documents", lambda d: F.struct(
        d["documentTitle"].alias("documentTitle"), d["documentType"].alias("documentType"), d["author"].alias("author"),
        F.struct(d["creation"]["date"].alias("date"), d["creation"]["year"].alias("year"), d["creation"]["raw"].alias("raw")).alias("creation"), d["publication"].alias("pearlPublication"), d["parts"].alias("parts")))
    year = F.coalesce("sitePublication.year", "sourceYear")
    out = issues.select(
        "slug", "title", "sitePublication", "documentsCount", inner.alias("documents"), "sourcePdf", "sourceWord", F.lit(None).cast("string").alias("preparedDocx"), parsed_path(F.col("slug"), year).alias("jsonPath"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("parsedAt"), "meta")
    parsed_json.write_issues(out, s.parsed)
    return parsed_issues(out.sparkSession, s)


def parsed_issues(spark: SparkSession, s: Settings) -> DataFrame:
    """Parsed issues as this engine writes them (one JSON line an issue)."""
    return spark.read.schema(parsed_json.SCHEMA).option("recursiveFileLookup", True).option("mode", "FAILFAST").json(s.parsed)


def audit(spark: SparkSession, s: Settings) -> DataFrame:
    return archive.audit(archive_files.read_listing(spark, s.sources))


def map_sources(spark: SparkSession, s: Settings) -> DataFrame:
    return archive.source_map(archive_files.read_listing(spark, s.sources))


def plan_moves(spark: SparkSession, s: Settings) -> DataFrame:
    return archive.move_plan(map_sources(spark, s), archive_files.read_listing(spark, s.sources))


def load_tables(spark: SparkSession, s: Settings) -> DataFrame:
    """Rebuild the catalog tables; returns their assertions."""
    issues = parsed_issues(spark, s)
    load.rebuild(issues, s.tables, s.default_year)
    return load.problems(*tables(spark, s))


def tables(spark: SparkSession, s: Settings) -> tuple[DataFrame, DataFrame]:
    now = load.current(spark, s.tables)
    return spark.read.parquet(f"{now}/containers"), spark.read.parquet(f"{now}/documents")


def export_issues(spark: SparkSession, s: Settings, year: int | None = None, slug: str | None = None) -> DataFrame:
    """Write all exports; one row a file with its error (null if written).  Any error fails the job at its end."""
    issues = parsed_issues(spark, s)
    issues = issues if year is None else issues.where(F.col("sitePublication.year") == year)
    issues = issues if slug is None else issues.where(F.col("slug") == slug)
    lines = lambda c: F.transform(c, lambda p: p["text"])
    docs = F.transform("documents", lambda d: F.struct(d["documentTitle"].alias("documentTitle"), d["parts"]["header"].alias("header"), lines(d["parts"]["body"]).alias("body"), lines(d["parts"]["footer"]).alias("footer")))
    rows = issues.select("slug", F.coalesce(F.col("sitePublication.year").cast("string"), F.lit("archive")).alias("year"), "title", F.col("sitePublication.label").alias("siteLabel"), docs.alias("documents"))
    return exports.write_files(exports.run(rows), s.exports)


def verify(spark: SparkSession, s: Settings, formats: list[str] | None = None) -> DataFrame:
    """Expected exports that are missing."""
    cont = tables(spark, s)[0].select(F.col("siteYear").alias("year"), "slug")
    found = archive_files.read_listing(spark, f"{s.exports}/downloads").select(F.concat(F.lit("downloads/"), "relativePath").alias("path")) if _exists(spark, f"{s.exports}/downloads") else spark.createDataFrame([], "path string")
    return archive.completeness(cont, found, formats)


def enrich_issues(spark: SparkSession, s: Settings, provider=enrich.null_provider, limit: int | None = None, force: bool = False) -> DataFrame:
    """Outcome of an enrichment of all inner documents."""
    rows = parsed_issues(spark, s).select("slug", F.col("sitePublication.label").alias("label"), F.col("sitePublication.rawLabel").alias("rawLabel"), F.posexplode("documents").alias("_i", "d"))
    text = lambda c: F.transform(c, lambda p: p["text"])
    docs = rows.select(
        "slug", (F.col("_i") + 1).alias("position"), "d.documentTitle", "d.documentType", "d.author", "d.creation", F.col("d.pearlPublication").alias("publication"), F.col("d.parts.header").alias("header"),
        text("d.parts.footer").alias("footerLines"), text("d.parts.body").alias("bodyLines"), "label", "rawLabel")
    return enrich.enrich(docs, provider, limit, force)


def smoke(spark: SparkSession, s: Settings) -> dict[str, bool]:
    """Quick checks of the products: tables, listing, detail, paths, an export of some length."""
    cont, docs = tables(spark, s)
    first = catalog.catalog(cont, docs, catalog.Filters()).select("slug", "siteYear").first()
    return {
        "tables": not cont.isEmpty(), "listing": first is not None, "detail": bool(first) and catalog.detail(cont, docs, first["siteYear"], first["slug"]).count() == 1,
        "paths": catalog.sitemap_paths(cont).count() == cont.count() + 1, "exports": verify(spark, s, ["txt"]).isEmpty(),
    }


def chain(spark: SparkSession, s: Settings, year: int | None = None, slug: str | None = None) -> DataFrame:
    """Parse, load, export and verify; a step that fails stops the chain."""
    parse_word(spark, s, year, slug)
    load_tables(spark, s)
    failed = export_issues(spark, s, year, slug).where("error is not null")
    if not failed.isEmpty():
        raise RuntimeError("exports failed: " + "; ".join(f"{r['path']}: {r['error']}" for r in failed.limit(20).collect()))
    return verify(spark, s, ["txt", "docx", "epub"])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_report(df: DataFrame, s: Settings, name: str) -> str:
    """Write a job's result as JSON lines below the root's reports; returns the folder."""
    path = f"{s.exports}/reports/{name}"
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


COMMANDS = {
    "prepare": prepare, "parse-word": parse_word, "parse-pdf": parse_pdf_items, "search": search_catalog, "changes": changes, "update": update, "audit": audit, "map": map_sources, "plan-moves": plan_moves, "load": load_tables, "export": export_issues, "verify": verify, "enrich": enrich_issues, "year": chain, "refresh": chain,
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="scriptoria.jobs", description=__doc__.split("\n")[0])
    p.add_argument("command", choices=[*COMMANDS, "smoke"])
    p.add_argument("--root", required=True)
    p.add_argument("--sources")
    p.add_argument("--year", type=int)
    p.add_argument("--slug")
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_true")
    p.add_argument("--write", action="store_true", help="prepare: name the actions of a run that writes; audit, map, plan-moves, enrich: write the result as JSON")
    p.add_argument("--quarter", type=int, choices=[1, 2, 3, 4])
    p.add_argument("--file", help="parse-word: one source file; parse-pdf: the table of positioned items")
    p.add_argument("--query", help="search: the text query")
    p.add_argument("--author")
    p.add_argument("--type", dest="kind")
    a = p.parse_args(argv)
    if a.command == "year" and a.year is None or a.command == "refresh" and a.slug is None:
        p.error("year needs --year, refresh needs --slug")
    if a.command == "search" and a.query is None or a.command == "parse-pdf" and a.file is None:
        p.error("search needs --query, parse-pdf needs --file")
    spark = SparkSession.builder.appName(f"scriptoria {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s = Settings.below(a.root, a.sources)
    if a.command == "smoke":
        found = smoke(spark, s)
        print(found)
        return int(not all(found.values()))
    known = {"prepare": {"year": a.year, "slug": a.slug, "dry_run": not a.write, "force": a.force}, "enrich": {"limit": a.limit, "force": a.force}}
    known |= {
        "parse-word": {"year": a.year, "slug": a.slug, "quarter": a.quarter, "file": a.file}, "parse-pdf": {"items": a.file},
        "search": {"q": a.query, "year": None if a.year is None else str(a.year), "author": a.author, "kind": a.kind},
    }
    picked = {"year": a.year, "slug": a.slug} if a.command in ("export", "year", "refresh") else {}
    found = COMMANDS[a.command](spark, s, **known.get(a.command, picked))
    if a.write and a.command in ("audit", "map", "plan-moves", "enrich"):
        print(write_report(found, s, a.command))
    else:
        found.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
