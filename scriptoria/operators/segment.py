"""Segmentation of an issue's paragraphs into inner documents, and the build of the parsed issue.

The running state of an issue (what its current document has so far, whether a header is expected or being read) is
folded over the paragraphs by one ``aggregate`` expression; it emits a segment number and a role for each paragraph,
and the parts are then gathered by filters.  Classifiers are evaluated once a line, before the fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import lines as L
from scriptoria.functions.authors import extract_author
from scriptoria.functions.dates import year_in_path
from scriptoria.functions.jsregex import index_of, normal_spaces, trim
from scriptoria.functions.publication import creation, document_type, issue_of, issue_slug, issue_title, publication_line
from scriptoria.functions.text import rounded_ratio
from scriptoria.functions.titles import with_title

PARAGRAPH = "struct<text:string,styleId:string,isBold:boolean,isItalic:boolean,maxFontSize:double,boldTextRatio:double>"
#: Lines in which the first heading is looked for, lines of a cover without one, and the length of running text.
SCAN, COVER_LINES, TEXT_LENGTH = 14, 4, 45
_STATE = "struct<seg:int,header:int,published:boolean,body:int,footer:int,expects:boolean,collects:boolean,roles:array<struct<seg:int,role:string>>>"


def clean_paragraphs(paragraphs: Column) -> Column:
    """Paragraphs with normal spaces and rounded ratios; empty ones and page numbers go."""
    tidy = F.transform(paragraphs, lambda p: F.struct(
        normal_spaces(p["text"]).alias("text"), p["styleId"].alias("styleId"), p["isBold"].alias("isBold"), p["isItalic"].alias("isItalic"),
        p["maxFontSize"].alias("maxFontSize"), rounded_ratio(p["boldTextRatio"]).cast("double").alias("boldTextRatio")))
    return F.filter(tidy, lambda p: (F.length(p["text"]) > 0) & ~L.is_page_number(p["text"]))


def body_start(paragraphs: Column) -> Column:
    """0-based index of the first paragraph after the cover and the first header."""
    near = F.slice(paragraphs, 1, SCAN)
    n = F.size(paragraphs)
    after = index_of(near, lambda p: L.is_heading(p["text"])) + 2
    running = index_of(near, lambda p: ~L.is_cover(p["text"]) & (F.length(p["text"]) >= TEXT_LENGTH))
    return F.coalesce(F.when(after < n, after), running, F.least(F.lit(COVER_LINES), n)).cast("int")


def _flags(paragraphs: Column, split_before: Column) -> Column:
    return F.transform(paragraphs, lambda p: F.struct(
        (L.is_page_number(p["text"]) | L.is_running_line(p["text"])).alias("drop"), L.is_attribution(p["text"]).alias("attribution"), L.is_publication(p["text"]).alias("publication"),
        L.is_heading(p["text"]).alias("heading"), F.coalesce(F.array_contains(F.transform(split_before, normal_spaces), normal_spaces(p["text"])), F.lit(False)).alias("mapped"),
        F.length(trim(p["text"])).alias("n"), L.ends_sentence(trim(p["text"])).alias("closed"), L.is_title_candidate(p["text"]).alias("candidate"),
    ))


def _step(s: Column, f: Column) -> Column:
    """Next state by the first rule that holds."""
    true, false = F.lit(True), F.lit(False)

    def to(role: str | None, seg=None, header=None, published=None, body=None, footer=None, expects=None, collects=None) -> Column:
        number = s["seg"] if seg is None else seg
        roles = F.array_append(s["roles"], F.struct(number.alias("seg"), F.lit(role).cast("string").alias("role")))
        pick = {"seg": number, "header": header, "published": published, "body": body, "footer": footer, "expects": expects, "collects": collects}
        return F.struct(*[(s[k] if v is None else v).alias(k) for k, v in pick.items()], roles.alias("roles")).cast(_STATE)

    opened = to("header", seg=s["seg"] + 1, header=F.lit(1), published=f["publication"], body=F.lit(0), footer=F.lit(0), expects=false, collects=true)
    short = F.when(s["published"], (f["n"] <= 90) & ~f["closed"]).otherwise(f["candidate"] | ~f["closed"])
    goes_on = s["collects"] & (f["n"] > 0) & (f["n"] <= 150) & (s["header"] < 4) & ~f["publication"] & short
    fresh = (s["body"] == 0) & (s["footer"] == 0)
    return (
        F.when(f["drop"], to(None))
        .when(f["attribution"], to("footer", footer=s["footer"] + 1, expects=true, collects=false))
        .when(f["publication"] & fresh, to("header", header=s["header"] + 1, published=true, expects=false, collects=true))
        .when(f["publication"] | (s["expects"] & f["heading"]) | (f["mapped"] & (s["body"] > 0)), opened)
        .when(goes_on, to("header", header=s["header"] + 1))
        .otherwise(to("body", body=s["body"] + 1, expects=false, collects=false))
    )


def segment(df: DataFrame, paragraphs: str = "paragraphs", split_before: str | None = None) -> DataFrame:
    """Add ``segments``: array of structs header, body, footer (arrays of paragraphs), without empty ones."""
    kept = df.columns
    mapped = F.col(split_before) if split_before else F.array().cast("array<string>")
    out = df.withColumn("_start", body_start(F.col(paragraphs)))
    out = out.withColumns({
        "_root": F.filter(F.slice(paragraphs, F.lit(1), F.col("_start")), lambda p: ~L.is_page_number(p["text"])),
        "_rest": F.slice(paragraphs, F.col("_start") + 1, F.size(paragraphs)),
    })
    out = out.withColumn("_flags", _flags(F.col("_rest"), mapped))
    start = F.struct(
        F.lit(0).alias("seg"), F.size("_root").alias("header"), F.exists("_root", lambda p: L.is_publication(p["text"])).alias("published"), F.lit(0).alias("body"), F.lit(0).alias("footer"),
        F.lit(False).alias("expects"), F.lit(False).alias("collects"), F.array().cast("array<struct<seg:int,role:string>>").alias("roles"),
    ).cast(_STATE)
    out = out.withColumn("_roles", F.aggregate("_flags", start, _step)["roles"])
    out = out.withColumn("_placed", F.zip_with("_rest", "_roles", lambda p, r: F.struct(p.alias("p"), r["seg"].alias("seg"), r["role"].alias("role"))))

    def part(k: Column, role: str) -> Column:
        return F.transform(F.filter("_placed", lambda x: (x["seg"] == k) & (x["role"] == role)), lambda x: x["p"])

    last = F.coalesce(F.array_max(F.transform("_roles", lambda r: r["seg"])), F.lit(0))
    segments = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
        F.when(k == 0, F.concat("_root", part(k, "header"))).otherwise(part(k, "header")).alias("header"), part(k, "body").alias("body"), part(k, "footer").alias("footer")))
    out = out.withColumn("segments", F.filter(segments, lambda s: (F.size(s["header"]) > 0) | (F.size(s["body"]) > 0) | (F.size(s["footer"]) > 0)))
    return out.select(*[F.col(f"`{c}`") for c in kept], "segments")


def page_count(footer_lines: Column) -> Column:
    """Largest whole positive number that stands alone in a footer line, 0 if none."""
    numbers = F.transform(footer_lines, lambda x: F.when(L.is_page_number(x), F.try_to_number(trim(x), F.lit("999999999")).cast("int")))
    return F.coalesce(F.array_max(F.filter(numbers, lambda n: n > 0)), F.lit(0))


def inner_documents(issues: DataFrame, key: str = "issueId", path: str = "sourcePath", override_titles: str | None = None) -> DataFrame:
    """One row an inner document: key, position and all its metadata, from issues with ``segments``."""
    extra = [F.col(override_titles).alias("_titles")] if override_titles else []
    rows = issues.select(key, F.col(path).alias("_path"), *extra, F.posexplode("segments").alias("_i", "_s"))
    rows = rows.select("*", F.col("_s.header").alias("header"), F.col("_s.body").alias("body"), F.col("_s.footer").alias("footer"))
    texts = {f"_{k}": F.transform(k, lambda p: p["text"]) for k in ("header", "body", "footer")}
    rows = rows.withColumns(texts).withColumn("_meta", F.array_join(F.concat("_header", "_footer"), "\n"))
    rows = rows.withColumns({
        "documentType": document_type(F.col("_meta")), "pearlPublication": publication_line(F.concat("_header", "_body", "_footer")),
        "creation": creation(F.array_join("_footer", "\n"), F.col("_path")),
    })
    rows = rows.withColumn("author", extract_author(F.col("_header"), F.col("_meta"), F.col("_path"), F.col("pearlPublication.raw")))
    rows = with_title(rows, "header", "body", "footer")
    if override_titles:
        mapped = F.get(F.col("_titles"), F.col("_i"))
        rows = rows.withColumns({"titleSource": F.when(F.length(mapped) > 0, "override").otherwise(F.col("titleSource")), "documentTitle": F.coalesce(F.nullif(mapped, F.lit("")), "documentTitle")})
    parts = F.struct(F.col("_header").alias("header"), F.col("body").alias("body"), F.col("footer").alias("footer")).alias("parts")
    return rows.select(key, (F.col("_i") + 1).alias("position"), "documentTitle", "titleSource", "documentType", "author", "creation", F.col("pearlPublication").alias("publication"), parts)


def build_issues(issues: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """Parsed issues from rows issueId, sourcePath, paragraphs, evidence (lines), pages, layout.

    ``override`` has sourcePath, splitBefore (lines) and titles (by position).
    """
    src = issues
    if override is not None:
        src = src.join(override.select("sourcePath", "splitBefore", "titles"), "sourcePath", "left")
    else:
        src = src.withColumns({"splitBefore": F.lit(None).cast("array<string>"), "titles": F.lit(None).cast("array<string>")})
    src = src.withColumn("splitBefore", F.coalesce("splitBefore", F.array().cast("array<string>")))
    cut = segment(src, "paragraphs", "splitBefore")
    docs = inner_documents(cut, override_titles="titles")
    gathered = docs.groupBy("issueId").agg(F.sort_array(F.collect_list(F.struct(*[c for c in docs.columns if c != "issueId"]))).alias("documents"))
    head = cut.select("issueId", "sourcePath", "pages", "layout", issue_of(F.col("sourcePath"), F.col("evidence")).alias("sitePublication"))
    head = head.withColumns({"slug": issue_slug(F.col("sourcePath"), F.col("sitePublication")), "title": issue_title(F.col("sitePublication.label"))})
    out = head.join(gathered, "issueId", "left")
    return out.select(
        "issueId", "slug", "title", "sitePublication", F.coalesce(F.size("documents"), F.lit(0)).alias("documentsCount"), "documents", F.col("sourcePath").alias("sourcePdf"),
        F.col("sourcePath").alias("sourceWord"), year_in_path(F.col("sourcePath")).alias("sourceYear"), F.struct("pages", "layout").alias("meta"),
    )
