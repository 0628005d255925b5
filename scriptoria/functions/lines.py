"""Classifiers of a publication's lines: text column -> boolean column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .jsregex import matches, trim
from .text import part_line, words_in, year_spaces_closed


def any_of(c: Column, patterns: list[str], flags: str = "iu") -> Column:
    """Whether one of the patterns occurs (they are one expression, so the text is searched once)."""
    return matches(c, "|".join(f"(?:{p})" for p in patterns), flags)


def is_page_number(c: Column) -> Column:
    return matches(trim(c), fixed.PAGE_NUMBER, "u")


def is_running_line(c: Column) -> Column:
    return matches(year_spaces_closed(trim(c)), fixed.RUNNING_CASED, "u")


def is_cover(c: Column) -> Column:
    return matches(c, fixed.SERIES) | is_running_line(c)


def is_publication(c: Column) -> Column:
    return matches(trim(c), fixed.PUBLICATION)


def is_heading(c: Column) -> Column:
    return matches(trim(c), fixed.HEADING)


def is_specific_heading(c: Column) -> Column:
    """A heading that says more than who speaks."""
    return is_heading(c) & ~any_of(trim(c), fixed.PLAIN_HEADINGS)


def is_attribution(c: Column) -> Column:
    return matches(trim(c), fixed.ATTRIBUTION)


def is_author_only(c: Column) -> Column:
    return matches(trim(c), fixed.AUTHOR_ONLY)


def is_retreat(c: Column) -> Column:
    t = trim(c)
    return matches(t, fixed.RETREAT) & (matches(year_spaces_closed(t), r"\b(?:19|20)\d{2}\b", "u") | (F.length(t) <= 60))


def ends_sentence(c: Column) -> Column:
    return matches(c, r"[.!?]$", "u")


def is_title_candidate(c: Column) -> Column:
    t = trim(c)
    barred = is_cover(t) | part_line(t).isNotNull() | any_of(t, fixed.NOT_TITLES) | is_author_only(t) | is_retreat(t) | is_heading(t) | is_publication(t)
    return ~barred & (F.length(t) <= 150) & ~((words_in(t) > 18) & ends_sentence(t))


def is_generic(c: Column) -> Column:
    t = trim(c)
    return is_cover(t) | is_publication(t) | is_author_only(t) | any_of(t, fixed.GENERIC) | is_retreat(t)


def is_lead_candidate(c: Column) -> Column:
    t = trim(c)
    return is_title_candidate(t) & ~is_generic(t) & ~any_of(t, fixed.NOT_LEADS)


def is_formatted_title(p: Column) -> Column:
    """A paragraph struct set in bold, mostly in bold, or large and short."""
    t = trim(p["text"])
    loud = F.coalesce(p["isBold"], F.lit(False)) | (F.coalesce(p["boldTextRatio"], F.lit(0.0)) >= 0.55)
    large = (F.coalesce(p["maxFontSize"], F.lit(0.0)) >= 13) & (F.length(t) <= 120)
    return is_lead_candidate(t) & (loud | large)


def continues_title(title: Column, line: Column) -> Column:
    """Whether ``line`` goes on with a title: it begins in lower case (perhaps after a quote) and the title is open."""
    t = trim(line)
    lower = matches(t, r"^[а-яё]", "u") | matches(t, r"^[«\"„][а-яё]", "u")
    return F.coalesce(lower & is_title_candidate(t) & ~ends_sentence(trim(title)), F.lit(False))


def continues_header(line: Column, header_size: Column, has_publication: Column) -> Column:
    """Whether a line still belongs to a header of so many lines."""
    t = trim(line)
    short = F.when(has_publication, (F.length(t) <= 90) & ~ends_sentence(t)).otherwise(is_title_candidate(t) | ~ends_sentence(t))
    return (F.length(t) > 0) & (F.length(t) <= 150) & (header_size < 4) & ~is_publication(t) & short
