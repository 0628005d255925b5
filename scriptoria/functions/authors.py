"""Authors: recognition in headers and file names, cleaning, and canonical names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .jsregex import first, let, matches, normal_spaces, rx, swap, text_or_null, trim
from .lines import any_of, is_author_only, is_publication
from .text import capitalised, name_slug, stem, words_in

_DASH = r"\s+[–-]\s+"


def nominative(c: Column) -> Column:
    """Names in the nominative; a name that no pattern meets is left at once."""
    def named(t: Column) -> Column:
        out = t
        for pattern, name in fixed.NOMINATIVES:
            out = swap(out, pattern, name, "u")
        return F.when(any_of(t, [p for p, _ in fixed.NOMINATIVES], "u"), out).otherwise(t)

    return let(c, named)


def dash_part(c: Column, k: int) -> Column:
    """The k-th part (from 0) between dashes that stand free."""
    return text_or_null(F.get(F.split(c, rx(_DASH, "u")), F.lit(k)))


def clean_author(raw: Column) -> Column:
    """Name in a header line: a canonical name, the second part of a publication line, or the line without its frame."""
    canonical = F.coalesce(*[F.when(matches(raw, p), F.lit(name)) for name, p in fixed.CANONICAL_AUTHORS])
    published = F.when(is_publication(raw), nominative(dash_part(raw, 1)))
    rest = raw
    for pattern, by in fixed.AUTHOR_STRIPS:
        rest = swap(rest, pattern, by)
    rest = nominative(normal_spaces(rest))
    return F.coalesce(canonical, published, F.when(F.length(rest).between(1, 100), rest))


def looks_like_title(name: Column, line: Column) -> Column:
    quoted = matches(line, r"[«»\"]", "u") & ~matches(name, fixed.TITLED_NAMES)
    numbered = matches(line, r"№\s*\d+", "u") | matches(name, r"№\s*\d+", "u")
    return quoted | numbered | ((words_in(name) <= 3) & ~matches(name, fixed.HOLY_NAMES))


def extract_author(header: Column, metadata_text: Column, source_path: Column, publication_raw: Column) -> Column:
    """struct(name, slug, raw) by precedence: publication line, author's own line, typed line, messenger, file name."""
    typed = first(header, lambda x: matches(x, fixed.TYPED_LINE))
    typed_name = clean_author(typed)
    by_type = F.when(typed_name.isNotNull() & ~looks_like_title(typed_name, typed), typed)
    messenger = F.coalesce(*[F.when(matches(metadata_text, p), F.lit(name)) for name, p in fixed.MESSENGERS])
    by_file = F.nullif(normal_spaces(F.regexp_extract(stem(source_path), rx(fixed.FILE_AUTHOR), 0)), F.lit(""))
    raw = F.coalesce(publication_raw, first(header, is_author_only), by_type, messenger, by_file)
    name = clean_author(raw)
    return F.struct(name.alias("name"), name_slug(name).alias("slug"), raw.alias("raw"))


def is_weak_name(c: Column) -> Column:
    quoted = matches(trim(c), r"^[«\"].*[»\"]$", "u") & ~matches(c, r"(?:Профет|Владык)")
    return (F.length(c) > 100) | matches(c, r"[.!?]$", "u") | quoted | (~matches(c, fixed.HOLY_NAMES_OR_MESSENGER) & (words_in(c) <= 3))


def normal_author(c: Column) -> Column:
    """Canonical name of the normaliser; weak names and noise are null."""
    def named(t: Column) -> Column:
        canonical = F.coalesce(*[F.when(matches(F.lower(t), p), F.lit(name)) for name, p in fixed.NORMAL_AUTHORS])
        usable = t.isNotNull() & ~any_of(t, fixed.NOISE) & ~is_weak_name(t)
        return F.when(usable, F.coalesce(canonical, nominative(capitalised(t))))

    return let(text_or_null(c), named)


def author_of_publication(raw: Column) -> Column:
    """Second part of a ``Том n`` line, unless it names the messenger."""
    second = lambda t: let(dash_part(t, 1), lambda name: F.when(~matches(name, r"посланник|профет"), name))
    return let(text_or_null(raw), lambda t: F.when(matches(t, r"^Том\.?\s+\d+"), second(t)))


def display_author(c: Column) -> Column:
    out = c
    for pattern, name in fixed.DISPLAY_NAMES:
        out = swap(out, pattern, name, "u")
    return F.nullif(trim(out), F.lit(""))
