"""Normalisation of metadata and the merge with enrichment records; all of it column expressions.

Inner documents are rows documentTitle, documentType, author(name, slug, raw), creation(date, year, raw),
publication(volume, issue, date, rawDate, raw) and header (lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import fixed
from scriptoria.functions.authors import author_of_publication, normal_author
from scriptoria.functions.dates import iso_date, plausible_year, positive
from scriptoria.functions.jsregex import capture, first, index_of, let, matches, swap, text_or_null, trim
from scriptoria.functions.lines import any_of, is_heading
from scriptoria.functions.text import name_slug, part_line, roman_parts, tight_punctuation, unquoted, words_in

SNAPSHOT = ["documentTitle", "documentType", "author", "creation", "publication"]


def is_noise(c: Column) -> Column:
    return any_of(c, fixed.NOISE)


def is_weak_title(c: Column) -> Column:
    return (F.length(c) > 150) | any_of(c, fixed.WEAK) | (matches(c, r"[.!?]$", "u") & (words_in(c) > 18))


def without_author(title: Column, author: Column) -> Column:
    """The title without the messengers' names, tidied."""
    out = title
    for p in fixed.AUTHOR_IN_TITLE:
        out = swap(out, p, "")
    def unmarked(t: Column) -> Column:
        mark = t
        for p in fixed.MARK_IN_TITLE:
            mark = swap(mark, p, "")
        return F.when(author.isin("Марк Л. Профет", "Марка Л. Профета"), mark).otherwise(t)

    out = let(out, unmarked)
    out = tight_punctuation(swap(out, r"\s+", " "))
    out = swap(out, r"^(Диктовка|Лекция|Курс\s+лекций|Учения|Проповедь)\s+по(?![\p{L}\p{N}])", "$1 по")
    out = swap(out, r"^Проповедь\s+в\s+праздник(?![\p{L}\p{N}])", "Проповедь праздник")
    return trim(swap(swap(out, r"\s+\(\s*", " ("), r"\s+\)", ")"))


def normal_title(c: Column, author: Column) -> Column:
    """A usable title without quotes, noise and author; null for markers, noise and weak titles."""
    def titled(t: Column) -> Column:
        usable = (F.length(t) > 0) & ~any_of(t, fixed.BODY_MARKERS) & ~is_noise(t) & ~is_weak_title(t)
        return F.when(usable, without_author(t, author))

    return let(roman_parts(unquoted(tight_punctuation(text_or_null(c)))), titled)


def _header_columns(df: DataFrame, header: str, author: str) -> DataFrame:
    """Add ``_headerTitle``: the title that header lines make, a structured part title first."""
    out = df.withColumn("_clean", F.filter(F.transform(header, text_or_null), lambda x: x.isNotNull() & ~is_noise(x)))
    quoted_after = F.transform("_clean", lambda x, i: F.coalesce(
        F.when(matches(x, r"^(Лекция|Проповедь|Диктовка)\s+"), capture(F.get(F.col("_clean"), i + 1), r"^[«\"]([^»\"]+)[»\"]$", 1, "u")), x))
    out = out.withColumns({
        "_part": first(F.transform(header, lambda x: part_line(x, as_roman=True)), lambda x: x.isNotNull()),
        "_at": index_of(F.col(header), lambda x: is_heading(x)), "_line": first(quoted_after, lambda x: matches(x, fixed.TITLE_LEADS)),
        "_q": first(F.transform(header, lambda x: capture(x, fixed.QUOTED, 1, "u")), lambda x: x.isNotNull()),
        "_course": first(F.transform(header, text_or_null), lambda x: matches(x, fixed.COURSE_LINE)),
    })
    heading, after = F.get(F.col(header), F.col("_at")), F.get(F.col(header), F.col("_at") + 1)
    more = (F.length(after) > 0) & part_line(after).isNull() & matches(trim(after), r"^[а-яё«\"]", "u")
    full = F.when(F.coalesce(more, F.lit(False)), F.concat_ws(" ", heading, after)).otherwise(heading)
    course = trim(swap(without_author(F.col("_course"), F.col(author)), r"\(?избранные\s+учения\)?", ""))
    main = F.when(heading.isNotNull(), full).when(F.col("_q").isNotNull(), F.col("_q")).otherwise(course)
    out = out.withColumn("_main", F.when(F.col("_part").isNotNull(), F.concat(main, F.lit(" ("), F.col("_part"), F.lit(")"))))
    out = out.withColumns({"_s": normal_title(F.col("_main"), F.col(author)), "_l": normal_title(F.col("_line"), F.col(author))})
    return out.withColumn("_headerTitle", F.coalesce("_s", "_l"))


def _normal_author_struct(current: Column, ai_name: Column, ai_raw: Column, publication_raw: Column, document_type: Column) -> Column:
    def of_line(by_line: Column) -> Column:
        chosen = F.coalesce(normal_author(F.coalesce(by_line, ai_name)), normal_author(current["name"]))
        raw = F.coalesce(by_line, text_or_null(ai_raw), current["raw"])
        return let(chosen, lambda name: F.struct(name.alias("name"), F.coalesce(name_slug(name), current["slug"]).alias("slug"), raw.alias("raw")))

    return let(F.when(document_type == "dictation", author_of_publication(publication_raw)), of_line)


def _with_titles(df: DataFrame, ai_title: Column | None) -> DataFrame:
    """Choose the title: a better header title, an enrichment title, the current one, the header's."""
    out = df.withColumn("_name", F.col("author.name"))
    out = _header_columns(out, "header", "_name")
    nothing = F.lit(None).cast("string")
    out = out.withColumns({"_now": normal_title(F.col("documentTitle"), F.col("_name")), "_ai": nothing if ai_title is None else normal_title(ai_title, F.col("_name"))})
    weak_now = F.col("_now").isNull() | F.coalesce(is_weak_title(F.col("_now")), F.lit(False))
    prefer = matches(F.col("_headerTitle"), fixed.TITLE_LEADS) & ~matches(F.col("_now"), fixed.TITLE_LEADS)
    ai = F.col("_ai").isNotNull() & ~is_weak_title(F.col("_ai")) & ~matches(F.col("_ai"), fixed.GENERIC_ATTRIBUTION)
    title = (
        F.when(F.col("_headerTitle").isNotNull() & (weak_now | prefer), F.col("_headerTitle")).when(ai, F.col("_ai"))
        .when(weak_now, F.col("_headerTitle")).otherwise(F.col("_now"))
    )
    return out.withColumn("documentTitle", title)


def normalise(docs: DataFrame) -> DataFrame:
    """Rows with normal author and title (other columns unchanged)."""
    author = _normal_author_struct(F.col("author"), F.col("author.name"), F.col("author.raw"), F.col("publication.raw"), F.col("documentType"))
    return _with_titles(docs.withColumn("author", author), None).select(*[F.col(f"`{c}`") for c in docs.columns])


def with_needs_enrichment(docs: DataFrame, name: str = "needsEnrichment") -> DataFrame:
    """Add whether no usable title can be made without help, the title that can, and the normal author."""
    kept = docs.columns
    ready = normalise(docs.withColumn("_old", F.struct(*SNAPSHOT)))
    return ready.select(*[(F.col(f"_old.{c}") if c in SNAPSHOT else F.col(f"`{c}`")).alias(c) for c in kept], F.col("documentTitle").alias("readyTitle"), F.col("author").alias("readyAuthor"), F.col("documentTitle").isNull().alias(name))


def is_trusted(raw: Column, evidence: Column | None) -> Column:
    """A claimed publication line counts if it is whole, has the form, and stands in the evidence (where there is any)."""
    t = text_or_null(raw)
    form = t.isNotNull() & ~matches(t, r"\.{3}|…", "u") & matches(t, r"^Том\.?\s+\d+")
    return form if evidence is None else form & F.coalesce(evidence.contains(t), F.lit(True))


def merge_enrichment(docs: DataFrame, evidence: str | None = None) -> DataFrame:
    """Merge column ``ai`` (documentTitle, documentType, author, creation, publication) into each row."""
    ai = F.col("ai")
    kind = F.coalesce(ai["documentType"], F.col("documentType"))
    author = _normal_author_struct(F.col("author"), ai["author"]["name"], ai["author"]["raw"], F.coalesce(F.col("publication.raw"), ai["publication"]["raw"]), kind)
    date = F.coalesce(iso_date(ai["creation"]["date"]), iso_date(F.col("creation.date")))
    year = F.coalesce(F.substring(date, 1, 4).cast("int"), plausible_year(ai["creation"]["year"]), F.col("creation.year"))
    made = F.struct(date.alias("date"), year.alias("year"), F.coalesce(text_or_null(ai["creation"]["raw"]), F.col("creation.raw")).alias("raw"))
    claim, now = ai["publication"], F.col("publication")
    trusted = is_trusted(claim["raw"], F.col(evidence) if evidence else None)
    new = F.struct(
        F.coalesce(positive(claim["volume"]), now["volume"]).alias("volume"), F.coalesce(text_or_null(claim["issue"]), now["issue"]).alias("issue"), F.coalesce(iso_date(claim["date"]), now["date"]).alias("date"),
        F.coalesce(text_or_null(claim["rawDate"]), now["rawDate"]).alias("rawDate"), F.coalesce(text_or_null(claim["raw"]), now["raw"]).alias("raw"),
    )
    out = docs.withColumns({"author": author, "documentType": kind, "creation": made, "publication": F.when(trusted, new).otherwise(now)})
    return _with_titles(out, ai["documentTitle"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def changed(old: str, new: str) -> Column:
    """Whether two snapshots differ, nulls compared as values."""
    return ~F.col(old).eqNullSafe(F.col(new))


def is_analysis_noise(line: Column, label: Column | None = None, raw_label: Column | None = None) -> Column:
    t = text_or_null(line)
    same = F.lit(False)
    for x in (label, raw_label):
        if x is not None:
            same = same | F.coalesce((F.length(x) > 0) & (t == x), F.lit(False))
    return t.isNull() | any_of(t, fixed.ANALYSIS_NOISE) | same | matches(t, fixed.RUNNING_CASED, "u")


def analysis_lines(lines: Column, label: Column | None = None, raw_label: Column | None = None) -> Column:
    """Lines worth showing to an enricher: normal spaces, without noise."""
    return F.filter(F.transform(lines, text_or_null), lambda x: ~is_analysis_noise(x, label, raw_label))


def looks_weak(c: Column) -> Column:
    t = text_or_null(c)
    return is_analysis_noise(t) | any_of(t, [*fixed.WEAK, fixed.INVOCATION]) | (F.length(t) > 150) | ((words_in(t) > 18) & matches(t, r"[.!?]$", "u"))


