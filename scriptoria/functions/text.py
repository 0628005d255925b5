"""Scalar text functions as Column -> Column (no Python runs per row)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed
from .jsregex import SPACES, first, let, matches, normal_spaces, rx, swap, trim


def transliterate(c: Column) -> Column:
    """Lower-case Latin form of Cyrillic letters; other characters stay."""
    out = F.lower(c)
    for letter, latin in fixed.TRANSLITERATION.items():
        if len(latin) > 1:
            out = F.replace(out, F.lit(letter), F.lit(latin))
    # one-letter targets first, so that letters without a target are dropped by translate
    short = sorted((x for x in fixed.TRANSLITERATION.items() if len(x[1]) < 2), key=lambda x: not x[1])
    return F.translate(out, "".join(k for k, _ in short), "".join(v for _, v in short))


def slug_part(c: Column) -> Column:
    """``&`` is "and", separators and other characters are single hyphens, none at the ends, lower case."""
    out = F.replace(c, F.lit("&"), F.lit(" and "))
    out = swap(swap(out, r"[_\s]+", "-"), r"[^a-zA-Z0-9-]+", "-", "")
    return F.lower(swap(swap(out, "-+", "-", ""), "^-|-$", "", ""))


def ascii_slug(c: Column, most: int = 48) -> Column:
    return F.substring(swap(swap(transliterate(c), "[^a-z0-9]+", "-", ""), "^-|-$", "", ""), 1, most)


def name_slug(c: Column) -> Column:
    return slug_part(transliterate(c))


def capitalised(c: Column) -> Column:
    """Only the first character in upper case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def unquoted(c: Column) -> Column:
    """Without one pair of wrapping quotes."""
    return trim(swap(trim(c), r"^[«\"„]\s*(.+?)\s*[»\"“]$", "$1", "u"))


def tight_punctuation(c: Column) -> Column:
    return swap(c, r"\s+([,.!?;:])", "$1", "u")


def year_spaces_closed(c: Column) -> Column:
    """``202 6`` is ``2026``."""
    return swap(c, r"\b([12])\s*(\d)\s*(\d)\s*(\d)\b", "$1$2$3$4", "u")


def roman(c: Column) -> Column:
    """Part number without spaces, in upper case; 1 to 10 as roman numerals."""
    table = F.create_map(*[F.lit(x) for pair in fixed.ROMAN.items() for x in pair])
    return let(F.upper(swap(c, r"\s+", "")), lambda token: F.coalesce(table[F.regexp_replace(token, r"^0+(?=\d)", "")], token))


def roman_parts(c: Column) -> Column:
    """``(Часть 3)`` is ``(Часть III)``; a text without such a part is left at once."""
    def parts(t: Column) -> Column:
        out = t
        for arabic, numeral in fixed.ROMAN.items():
            out = swap(out, rf"\(Часть\s+0*{arabic}\)", f"(Часть {numeral})")
        return F.when(matches(t, r"\(Часть\s+\d+\)"), swap(out, r"\(Часть\s+(\d+)\)", "(Часть $1)")).otherwise(t)

    return let(c, parts)


def part_line(c: Column, as_roman: bool = False) -> Column:
    """``(часть IV)`` is ``Часть IV``; null for other lines."""
    def part(t: Column) -> Column:
        number = F.regexp_extract(t, rx(fixed.PART_LINE), 1)
        return F.when(matches(t, fixed.PART_LINE), F.concat(F.lit("Часть "), roman(number) if as_roman else F.upper(swap(number, r"\s+", ""))))

    return let(trim(c), part)


def xml_decoded(c: Column) -> Column:
    out = c
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def xml_escaped(c: Column) -> Column:
    out = c
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def solid_length(c: Column) -> Column:
    """Number of characters that are not white space."""
    return F.length(swap(c, r"\s+", ""))


def rounded_ratio(c: Column) -> Column:
    return F.floor(c * 1000 + 0.5) / 1000


def words_in(c: Column) -> Column:
    """Number of pieces between runs of white space (as a split counts them)."""
    return F.size(F.split(c, rx(r"\s+", "")))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; a leading dot alone is no extension."""
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"^(.+)\.[^.]*$", "$1")


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def swapped_doc(path: Column) -> Column:
    """``.doc`` for ``.docx`` and the other way round; null for other paths."""
    return F.when(path.endswith(".docx"), F.regexp_replace(path, "x$", "")).when(path.endswith(".doc"), F.concat(path, F.lit("x")))


def split_paragraphs(content: Column, between: str = r"\n{2,}", spaces: str = SPACES) -> Column:
    """Paragraphs between blank lines (or what ``between`` matches); those of nothing but ``spaces`` are dropped."""
    return F.filter(F.split(content, between), lambda x: F.rlike(x, F.lit(f"[^{spaces}]")))


def description(body: Column, header: Column) -> Column:
    """First paragraph of more than 80 characters, else the header lines; one line of at most 180 characters."""
    long = first(body, lambda p: F.length(trim(p)) > 80)
    return F.substring(normal_spaces(F.coalesce(long, F.array_join(header, ". "))), 1, 180)


def path_key(path: Column) -> Column:
    """Case-insensitive key of a path; composed letters й and ё are folded into their single forms."""
    return F.lower(composed(path))


def composed(c: Column) -> Column:
    """Canonical composition of the letters that Cyrillic file names decompose (й, ё and their capitals)."""
    out = c
    for base, mark, single in (("и", "̆", "й"), ("И", "̆", "Й"), ("е", "̈", "ё"), ("Е", "̈", "Ё")):
        out = F.replace(out, F.lit(base + mark), F.lit(single))
    return out


def sorted_record(m: Column) -> Column:
    """A map with its keys in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Full canonical composition (``composed`` covers the Cyrillic letters without leaving the JVM)."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def short_digest(*parts: Column) -> Column:
    """First 12 hexadecimal digits of the SHA-1 of parts joined by colons: names of temporary folders."""
    return F.substring(F.sha1(F.concat_ws(":", *parts)), 1, 12)


def page_description(body_lines: Column) -> Column:
    """First 160 characters of all body text, for search engines."""
    return F.substring(F.array_join(body_lines, " "), 1, 160)


def absolute_url(site: str, path: Column) -> Column:
    return F.concat(F.lit(site.rstrip("/")), path)
