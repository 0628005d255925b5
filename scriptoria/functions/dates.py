"""Dates, months, quarters and labels as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .jsregex import capture, first, matches, swap, text_or_null, trim
from .text import composed, stem, year_spaces_closed

_WORD_BEFORE, _WORD_AFTER = r"(?:^|[^\p{L}])", r"(?=$|[^\p{L}])"


def _lookup(table: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def iso_day(year: Column, month: Column, day: Column) -> Column:
    """``YYYY-MM-DD``, null for days that the calendar lacks."""
    text = F.concat_ws("-", year.cast("string"), pad2(month), pad2(day))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull() & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text)


def russian_date(c: Column) -> Column:
    """ISO day of the first ``d[, d] month yyyy``; null if there is none or the calendar lacks it."""
    text = year_spaces_closed(F.lower(c))
    text = swap(text, r"\b(\d)\s+(\d)\s+([а-яё]+)\s+((?:19|20)\d{2})\b", "$1$2 $3 $4", "u")
    pattern = r"(\d{1,2})(?:\s*,\s*\d{1,2})?\s+([а-яё]+)\s+((?:19|20)\d{2})"
    day, word, year = (capture(text, pattern, k, "u") for k in (1, 2, 3))
    return iso_day(year.cast("int"), _lookup(fixed.MONTHS, word), day.cast("int"))


def iso_date(c: Column) -> Column:
    """The text if it is a day of the 20th or 21st century's calendar, else null."""
    t = text_or_null(c)
    return F.when(matches(t, r"^(?:19|20)\d{2}-\d{2}-\d{2}$", "") & F.try_to_date(t, "yyyy-MM-dd").isNotNull(), t)


def plausible_year(c: Column) -> Column:
    return F.when(c.between(1000, 2999), c)


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def year_in_text(c: Column) -> Column:
    return capture(year_spaces_closed(c), r"\b((?:19|20)\d{2})\b", 1, "u").cast("int")


def year_in_path(c: Column) -> Column:
    return capture(c, r"(?:^|/)((?:19|20)\d{2})(?:/|$)", 1, "u").cast("int")


def month_in_text(c: Column, english: bool = False) -> Column:
    table = fixed.MONTHS | (fixed.ENGLISH_MONTHS if english else {})
    return _lookup(table, capture(F.lower(year_spaces_closed(c)), rf"{_WORD_BEFORE}({'|'.join(table)}){_WORD_AFTER}"))


def month_of_english_folder(parts: Column) -> Column:
    """Leading number of the first path part that names a month: ``03_March`` is 3."""
    table = fixed.MONTHS | fixed.ENGLISH_MONTHS
    named = F.filter(parts, lambda p: matches(F.lower(p), rf"{_WORD_BEFORE}({'|'.join(table)}){_WORD_AFTER}") & matches(p, r"^(?:0?[1-9]|1[0-2])[_\s-]", "u"))
    return capture(F.get(named, F.lit(0)), r"^(\d{1,2})[_\s-]", 1, "u").cast("int")


def month_of_slug(name: Column) -> Column:
    pattern = r"(?:^|[^0-9])(?:19|20)\d{2}Q([1-4])-([1-3])(?:$|[^0-9])"
    return ((capture(name, pattern, 1).cast("int") - 1) * 3 + capture(name, pattern, 2).cast("int")).cast("int")


def month_of_index(name: Column, quarter: Column) -> Column:
    """``кв. 2`` is the second month of the quarter."""
    return ((quarter - 1) * 3 + capture(name, r"кв\.\s*([1-3])").cast("int")).cast("int")


def month_of_number(name: Column, quarter: Column) -> Column:
    """A leading number: place in the quarter (1 to 3) or month of the year, if that lies in the quarter."""
    n = capture(name, r"^(\d{1,2})[_\s-]", 1, "u").cast("int")
    return F.when(n.between(1, 3), (quarter - 1) * 3 + n).when(n.between((quarter - 1) * 3 + 1, quarter * 3), n).cast("int")


def quarter_of_segment(part: Column) -> Column:
    """``Q2``, ``2-й квартал`` and looser forms."""
    t = trim(composed(part))
    forms = [r"^Q([1-4])$", r"^([1-4])-[йи]\s+квартал$", r"(?:^|\s)([1-4])\s*(?:-|й|и)?\s*квартал(?:\s|$)"]
    return F.coalesce(*[capture(t, f) for f in forms]).cast("int")


def quarter_of_path(parts: Column) -> Column:
    return F.get(F.filter(F.transform(parts, quarter_of_segment), lambda q: q.isNotNull()), F.lit(0))


def year_of_parts(parts: Column) -> Column:
    return first(parts, lambda p: matches(p, r"^(?:19|20)\d{2}$", "u")).cast("int")


def month_name(month: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in fixed.MONTH_NAMES]), month - 1)


def site_label(label: Column, year: Column, month: Column) -> Column:
    """Stored label, else month name and year, else the year."""
    return F.coalesce(F.nullif(label, F.lit("")), F.when(month > 0, F.concat_ws(" ", month_name(month), year.cast("string"))), year.cast("string"))


def month_only_label(label: Column, year: Column, month: Column) -> Column:
    return F.when(month.isNotNull(), F.replace(label, F.concat(F.lit(" "), year.cast("string")), F.lit(""))).otherwise(label)


def long_date(day: Column) -> Column:
    """``1 февраля 1970 год``."""
    names = F.array(*[F.lit(x) for x in fixed.MONTH_GENITIVES])
    return F.when(day.isNotNull(), F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.get(names, F.month(day) - 1), F.year(day).cast("string"), F.lit("год")))


def numeric_date(c: Column) -> Column:
    """``dd.MM.yyyy`` from ``d.M.yyyy``."""
    p = F.split(c, r"\.")
    return F.concat_ws(".", F.lpad(F.get(p, F.lit(0)), 2, "0"), F.lpad(F.get(p, F.lit(1)), 2, "0"), F.get(p, F.lit(2)))


def site_publication(year: Column, month: Column, raw_label: Column) -> Column:
    """Label, months and sort date of an issue."""
    y = year.cast("string")
    both = year.isNotNull() & month.isNotNull()
    key = F.concat_ws("-", y, pad2(month))
    return F.struct(
        F.when(both, F.concat_ws(" ", month_name(month), y)).otherwise(y).alias("label"), raw_label.alias("rawLabel"), year.alias("year"),
        F.when(both, month).alias("month"), F.when(both, F.array(key)).otherwise(F.array().cast("array<string>")).alias("months"),
        F.when(both, F.concat(key, F.lit("-01"))).when(year.isNotNull(), F.concat(y, F.lit("-01-01"))).alias("sortDate"),
    )


def source_publication(path: Column) -> Column:
    """Year, quarter, month and raw label that a source path tells."""
    p = composed(F.replace(path, F.lit("\\"), F.lit("/")))
    name, quarter, year = stem(p), quarter_of_path(F.split(p, "/")), year_in_path(p)
    month = F.coalesce(month_in_text(name), month_of_slug(name), month_of_index(name, quarter), month_of_number(name, quarter))
    raw = F.when(year.isNotNull() & month.isNotNull(), F.concat_ws(" ", F.lower(month_name(month)), year.cast("string")))
    return F.struct(year.alias("year"), quarter.alias("quarter"), month.alias("month"), raw.alias("rawLabel"))
