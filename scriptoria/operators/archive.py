"""Archive operators: listings, audit, identity of source files, canonical names, preferences, completeness.

Listings are rows relativePath, size, sha256, mtime (and ``head``, the first bytes).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import fixed
from scriptoria.functions.dates import month_in_text, month_of_english_folder, month_of_index, month_of_number, month_of_slug, pad2, quarter_of_path, year_of_parts
from scriptoria.functions.jsregex import matches
from scriptoria.functions.text import ascii_slug, basename, composed, dirname, extension, path_key, sorted_record, stem, swapped_doc

from .catalog import ranked


def is_skipped(path: Column) -> Column:
    """Whether any part of a path is on the skip list."""
    return F.exists(F.split(path, "/"), lambda p: p.isin(*fixed.SKIPPED_NAMES))


def listing(files: DataFrame) -> DataFrame:
    """A clean listing: composed paths, extensions, without skipped entries."""
    out = files.where(~is_skipped(F.col("relativePath"))).withColumn("relativePath", composed(F.col("relativePath")))
    return out.withColumn("extension", extension(F.col("relativePath")))


def directory_count(files: DataFrame) -> DataFrame:
    """Number of directories that hold a file, at any depth (empty ones leave no trace in a listing)."""
    parts = F.split("relativePath", "/")
    above = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).otherwise(F.array().cast("array<string>"))
    return files.select(F.explode(above).alias("dir")).agg(F.count_distinct("dir").alias("directories"))


def detect_format(path: Column, ext: Column) -> Column:
    low = F.lower(path)
    parts = F.split(low, "/")
    out = F.when(F.array_contains(parts, "word"), "word").when(F.array_contains(parts, "pdf-mailing"), "pdf-mailing").when(F.array_contains(parts, "pdf-print"), "pdf-print")
    out = out.when(F.array_contains(parts, "originals") | matches(low, r"оригинал|original|исходн|old|архив", "u"), "originals")
    return out.when((ext == ".pdf") & matches(low, "печат", "u"), "pdf-print").when(ext == ".pdf", "pdf-mailing").when(ext.isin(".doc", ".docx"), "word").otherwise("originals")


def with_identity(files: DataFrame) -> DataFrame:
    """Add year, quarter, month and format that a path tells."""
    path, parts, name = F.col("relativePath"), F.split("relativePath", "/"), stem(F.col("relativePath"))
    out = files.withColumns({"year": year_of_parts(parts), "_q": quarter_of_path(parts), "_name": name})
    month = F.coalesce(month_in_text(path, english=True), month_of_english_folder(parts), month_of_slug(F.col("_name")), month_of_index(F.col("_name"), F.col("_q")), month_of_number(F.col("_name"), F.col("_q")))
    out = out.withColumn("month", month)
    out = out.withColumn("quarter", F.coalesce("_q", F.ceil(F.col("month") / 3).cast("int")))
    return out.withColumn("format", F.when(F.col("quarter").isNotNull(), detect_format(path, F.col("extension"))).otherwise("originals")).drop("_q", "_name")


def counts(files: DataFrame, key: Column, domain: list[str] | None = None) -> DataFrame:
    """key, n in key order; with a domain, absent keys count 0."""
    found = files.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    if domain is not None:
        keys = files.sparkSession.createDataFrame([(k,) for k in domain], "key string")
        found = keys.join(found, "key", "left").select("key", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return found.orderBy("key")


def duplicate_basenames(files: DataFrame) -> DataFrame:
    """name, paths of file names (case aside) that occur more than once."""
    groups = files.groupBy(F.lower(basename(F.col("relativePath"))).alias("name")).agg(F.sort_array(F.collect_list("relativePath")).alias("paths"))
    return groups.where(F.size("paths") > 1).orderBy("name")


def case_conflicts(files: DataFrame, path: str = "relativePath") -> DataFrame:
    """key, spellings of path parts that differ in case only, under one parent."""
    parts = F.split(path, "/")
    rows = files.select(F.posexplode(parts).alias("i", "part"), parts.alias("all"))
    rows = rows.select(F.concat(F.array_join(F.slice("all", F.lit(1), F.col("i")), "/"), F.lit("/"), F.lower("part")).alias("key"), "part").distinct()
    return rows.groupBy("key").agg(F.sort_array(F.collect_set("part")).alias("spellings")).where(F.size("spellings") > 1).orderBy("key")


def longest_paths(files: DataFrame, n: int = 25, path: str = "relativePath") -> DataFrame:
    """Top-n longest paths (a distributed top-k)."""
    return files.select(F.col(path).alias("path"), F.length(path).alias("length")).orderBy(F.desc("length"), "path").limit(n)


def audit(files: DataFrame) -> DataFrame:
    """One row: the whole audit report."""
    ids = with_identity(files)
    ext = F.when(F.length("extension") > 0, F.col("extension")).otherwise("[none]")

    def record(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(sorted_record(F.map_from_entries(F.collect_list(F.struct("key", "n")))).alias(name))

    total = ids.agg(F.count(F.lit(1)).alias("filesCount"), F.coalesce(F.max(F.length("relativePath")), F.lit(0)).alias("maxPathLength"))
    pieces = [
        directory_count(files), record(counts(ids, ext), "extensionCounts"), record(counts(ids, F.coalesce(F.col("year").cast("string"), F.lit("unknown"))), "yearCounts"),
        record(counts(ids, F.col("format"), fixed.FORMATS), "formatCounts"),
        longest_paths(files).agg(F.transform(F.sort_array(F.collect_list(F.struct(-F.col("length"), "path"))), lambda x: x["path"]).alias("longestPaths")),
        duplicate_basenames(files).agg(F.map_from_entries(F.collect_list(F.struct("name", "paths"))).alias("duplicateBasenames")),
        case_conflicts(files).agg(F.map_from_entries(F.collect_list(F.struct("key", "spellings"))).alias("caseConflicts")),
    ]
    for p in pieces:  # one-row aggregates side by side
        total = total.crossJoin(F.broadcast(p))
    return total


def primary_names(files: DataFrame) -> DataFrame:
    """Add targetDir and primaryName of files with an identity."""
    slug = F.coalesce(F.nullif(ascii_slug(stem(F.col("relativePath"))), F.lit("")), F.lit("source"))
    place = F.col("month") - (F.col("quarter") - 1) * 3
    year = F.col("year").cast("string")
    name = (
        F.when((F.col("year").isNotNull()) & place.between(1, 3), F.concat(year, F.lit("Q"), F.col("quarter").cast("string"), F.lit("-"), place.cast("string")))
        .when(F.col("year").isNotNull() & F.col("month").isNotNull(), F.concat_ws("-", year, pad2(F.col("month")))).when(F.col("year").isNotNull(), F.concat_ws("-", year, slug)).otherwise(slug)
    )
    quarter = F.coalesce(F.concat(F.lit("Q"), F.col("quarter").cast("string")), F.lit("Q0"))
    return files.withColumns({"targetDir": F.concat_ws("/", F.coalesce(year, F.lit("archive")), quarter, "format"), "primaryName": F.concat(name, "extension"), "nameSlug": ascii_slug(stem(F.col("relativePath")))})


def _unique(rows: pd.DataFrame) -> pd.DataFrame:
    """New paths of one directory's files in path order; taken names (case aside) get the file's slug and a number."""
    taken: set[str] = set()
    out = []
    for r in rows.sort_values("relativePath", kind="stable").itertuples(index=False):
        base = r.primaryName.removesuffix(r.extension) if r.extension else r.primaryName
        suffix, k, path = r.nameSlug or "copy", 2, f"{r.targetDir}/{r.primaryName}"
        while path.lower() in taken:
            path = f"{r.targetDir}/{base}-{suffix}{f'-{k}' if k > 2 else ''}{r.extension}"
            k += 1
        taken.add(path.lower())
        out.append((r.relativePath, path))
    return pd.DataFrame(out, columns=["oldPath", "newPath"])


def source_map(files: DataFrame) -> DataFrame:
    """oldPath, newPath and what is known of each file; names are unique within their directory."""
    ids = primary_names(with_identity(files))
    paths = ids.select("targetDir", "relativePath", "extension", "primaryName", "nameSlug").groupBy("targetDir").applyInPandas(_unique, "oldPath string, newPath string")
    rest = [c for c in ("size", "sha256") if c in files.columns]
    facts = ids.select(F.col("relativePath").alias("oldPath"), "year", "quarter", "month", "format", basename(F.col("relativePath")).alias("originalName"), "extension", *rest)
    return facts.join(paths, "oldPath")


def move_plan(map_items: DataFrame, existing: DataFrame) -> DataFrame:
    """oldPath, newPath, status (keep, move, moved, missing), longest old path first; nothing is moved here."""
    here = existing.select(F.col("relativePath").alias("_p")).distinct()
    old = map_items.join(here.withColumnRenamed("_p", "_old"), F.col("oldPath") == F.col("_old"), "left").join(here.withColumnRenamed("_p", "_new"), F.col("newPath") == F.col("_new"), "left")
    status = F.when(F.col("oldPath") == F.col("newPath"), "keep").when(F.col("_old").isNotNull(), "move").when(F.col("_new").isNotNull(), "moved").otherwise("missing")
    return old.select("oldPath", "newPath", status.alias("status")).orderBy(F.desc(F.length("oldPath")), "oldPath")


def is_canonical(path: Column) -> Column:
    return matches(stem(path), fixed.CANONICAL_STEM, "u")


def word_sources(files: DataFrame) -> DataFrame:
    """Word files of canonical issues in a word directory, without editors' lock files, with year, quarter and output path."""
    rows = listing(files)
    parent = F.lower(F.trim(basename(dirname(F.col("relativePath")))))
    kept = rows.where(parent.isin(*fixed.WORD_DIRS) & F.col("extension").isin(".doc", ".docx") & ~basename(F.col("relativePath")).startswith("~$") & is_canonical(F.col("relativePath")))
    parts = F.split("relativePath", "/")
    kept = kept.withColumns({"year": year_of_parts(parts), "quarter": quarter_of_path(parts), "slug": stem(F.col("relativePath"))})
    return kept.withColumn("outputPath", F.concat_ws("/", F.col("year").cast("string"), F.concat(F.lit("Q"), F.col("quarter").cast("string")), F.lit("word"), F.concat("slug", F.lit(".docx"))))


def preferred_word_sources(sources: DataFrame) -> DataFrame:
    """One source an output: .docx before .doc, then the first path."""
    return ranked(sources, ["outputPath"], [F.when(F.col("extension") == ".docx", 0).otherwise(1), "relativePath"])


def candidate_ranks(files: DataFrame) -> DataFrame:
    """slug, relativePath, rank of all files that can be an issue's source: word directory (.docx, .doc, .pdf), mailing, print."""
    rows = listing(files).withColumns({"slug": stem(F.col("relativePath")), "_dir": F.lower(basename(dirname(F.col("relativePath"))))})
    word = F.col("_dir").isin(*fixed.WORD_DIRS)
    pdf = F.col("extension") == ".pdf"
    mailing = (F.col("_dir") == fixed.MAILING_DIR) | F.col("_dir").startswith(fixed.MAILING_PREFIX)
    rank = F.when(word & (F.col("extension") == ".docx"), 1).when(word & (F.col("extension") == ".doc"), 2).when(word & pdf, 3).when(mailing & pdf, 4).when(F.col("_dir").isin(*fixed.PRINT_DIRS) & pdf, 5)
    return rows.where(is_canonical(F.col("relativePath"))).withColumn("rank", rank).where("rank is not null").drop("_dir")


def preferred_sources(files: DataFrame) -> DataFrame:
    """The best source of every issue (lowest rank, then path)."""
    return ranked(candidate_ranks(files), ["slug"], ["rank", "relativePath"])


def resolve_source(files: DataFrame, slug: str) -> DataFrame:
    """One issue's source; an unknown or malformed slug is an error that says where was looked."""
    import re

    m = re.fullmatch(r"((?:19|20)\d{2})Q([1-4])-([1-3])", slug.strip())
    if not m:
        raise ValueError(f"invalid issue slug: {slug} (expected for example 2011Q4-1)")
    found = preferred_sources(files).where(F.col("slug") == slug.strip())
    if found.isEmpty():
        raise LookupError(f"no source for {slug}: no {slug}.docx, .doc or .pdf in a word, mailing or print directory of {m[1]}/Q{m[2]}")
    return found


def has_magic(head: Column, ext: Column) -> Column:
    """Whether the first bytes fit the extension (at least four are needed)."""
    ole, zipped = F.hex(F.substring(head, 1, 4)) == "D0CF11E0", F.hex(F.substring(head, 1, 2)) == "504B"
    return F.coalesce((F.octet_length(head) >= 4) & F.when(ext == ".doc", ole).otherwise(zipped), F.lit(False))


def prepare_outcome(sources: DataFrame, outputs: DataFrame, dry_run: bool = False, force: bool = False) -> DataFrame:
    """Add ``outcome``: what a preparation run does with each source, by the first rule that holds."""
    made = outputs.select(F.col("relativePath").alias("outputPath"), F.col("mtime").alias("_made"))
    docx = F.col("extension") == ".docx"
    fresh = F.lit(not force) & F.coalesce(F.col("_made") >= F.col("mtime"), F.lit(False))
    out = F.when(fresh, "skipped").when(~has_magic(F.col("head"), F.col("extension")), "skipped-invalid")
    out = out.when(docx, "would-copy").otherwise("would-convert") if dry_run else out.when(docx, "copied").otherwise("converted")
    return sources.join(made, "outputPath", "left").withColumn("outcome", out).drop("_made")


OUTCOMES = ["skipped", "skipped-invalid", "would-copy", "would-convert", "copied", "converted"]


def map_lookup(paths: DataFrame, items: DataFrame, path: str = "path") -> DataFrame:
    """Add the source-map item of each path: old or new path, case and .doc/.docx aside, first item of the map.

    An OR-join becomes an equi-join on exploded keys.
    """
    keys = F.array_distinct(F.filter(F.array(path_key(F.col(path)), path_key(swapped_doc(F.col(path)))), lambda x: x.isNotNull()))
    asked = paths.select(path, F.explode(keys).alias("_k")).distinct()
    known = items.select(F.explode(F.array_distinct(F.array(path_key(F.col("oldPath")), path_key(F.col("newPath"))))).alias("_k"), "item_pos", "oldPath", "newPath")
    best = asked.join(known, "_k").groupBy(path).agg(F.min_by(F.struct("oldPath", "newPath"), F.col("item_pos")).alias("item"))
    return paths.join(best, path, "left")


def override_lookup(issues: DataFrame, overrides: DataFrame, items: DataFrame | None = None, prefix: str = fixed.STORED_PREFIX, legacy: str = fixed.LEGACY_PREFIX) -> DataFrame:
    """Override of each issue: the first key that is known, among the path, its legacy forms and its mapped names."""
    p = F.col("sourcePath")
    keys = [p, F.regexp_replace(p, prefix, legacy), F.regexp_replace(p, legacy, prefix)]
    rows = issues.select("sourcePath").distinct()
    if items is not None:
        rows = map_lookup(rows.withColumn("path", F.regexp_replace("sourcePath", rf"^(?:\./)?(?:{legacy}|{prefix})", "")), items)
        for c in ("item.oldPath", "item.newPath"):
            keys += [F.col(c), F.concat(F.lit(prefix), F.col(c)), F.concat(F.lit(legacy), F.col(c))]
    asked = rows.select("sourcePath", F.posexplode(F.array(*keys)).alias("_rank", "path"))
    found = asked.join(overrides, "path").groupBy("sourcePath").agg(F.min_by(F.struct(*[c for c in overrides.columns if c != "path"]), F.col("_rank")).alias("_o"))
    return found.select("sourcePath", "_o.*")


def completeness(expected: DataFrame, existing: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Expected exports (year, slug crossed with the few formats) that do not exist: path."""
    kinds = expected.sparkSession.createDataFrame([(f,) for f in formats or fixed.EXPORT_FORMATS], "format string")
    paths = expected.crossJoin(F.broadcast(kinds)).select(F.concat(F.lit("downloads/"), F.col("year").cast("string"), F.lit("/"), "slug", F.lit("."), "format").alias("path"))
    return paths.join(existing.select("path"), "path", "left_anti")


def outcome_counts(rows: DataFrame) -> DataFrame:
    return counts(rows, F.col("outcome"), OUTCOMES)


def latest(files: DataFrame, key: str, when: str) -> DataFrame:
    """Newest row of each key."""
    return files.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(when)))).where("_r = 1").drop("_r")


def prepared_sources(prepared: DataFrame, files: DataFrame) -> DataFrame:
    """Prepared copies with the original of each: relativePath, sourcePath; a copy without an original is an error."""
    rows = listing(prepared).where(F.col("extension") == ".docx").withColumn("slug", stem(F.col("relativePath")))
    best = ranked(candidate_ranks(files).where("rank <= 2"), ["slug"], ["rank", "relativePath"]).select("slug", F.col("relativePath").alias("_source"))
    lost = F.raise_error(F.concat(F.lit("no source of "), F.col("relativePath"))).cast("string")
    return rows.join(best, "slug", "left").select("relativePath", "slug", F.coalesce("_source", lost).alias("sourcePath"))


def pdf_jobs(paths: DataFrame) -> DataFrame:
    """Checked PDF jobs (relativePath): other files and other names are errors."""
    wrong = F.when(extension(F.col("relativePath")) != ".pdf", "not a PDF: ").when(~is_canonical(F.col("relativePath")), "not an issue's name: ")
    checked = F.when(wrong.isNull(), F.col("relativePath")).otherwise(F.raise_error(F.concat(wrong, "relativePath")).cast("string"))
    return paths.withColumn("relativePath", checked)


def map_metadata(paths: DataFrame, items: DataFrame, path: str = "path") -> DataFrame:
    """Add originalName, oldPath, newPath of each path's item: old or new path as stored or without the stored prefix."""
    plain = F.regexp_replace(path, rf"^(?:\\./)?(?:{fixed.LEGACY_PREFIX}|{fixed.STORED_PREFIX})", "")
    asked = paths.select(path, F.explode(F.array_distinct(F.array(F.col(path), plain))).alias("_k")).distinct()
    known = items.select(F.explode(F.array("oldPath", "newPath")).alias("_k"), "item_pos", "originalName", "oldPath", "newPath")
    best = asked.join(known, "_k").groupBy(path).agg(F.min_by(F.struct("originalName", "oldPath", "newPath"), F.col("item_pos")).alias("sourceMap"))
    return paths.join(best, path, "left")
