"""Document type, creation, publication line, issue and slug."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .dates import month_in_text, pad2, russian_date, site_publication, source_publication, year_in_path, year_in_text
from .jsregex import capture, first, matches, normal_spaces
from .lines import is_publication
from .text import name_slug, stem


def document_type(text: Column) -> Column:
    """Type by the first rule that holds."""
    low = F.lower(text)
    own_line = r"(^|\n)\s*(открывающий\s+)?призыв\s*(\n|$)|(^|\n)\s*молитва\s*(\n|$)"
    return (
        F.when(low.contains("диктовка"), "dictation").when(matches(low, r"курс\s+лекций"), "lectureCourse").when(low.contains("проповедь"), "sermon")
        .when(matches(low, r"(^|\s)учения(\s|$)"), "teaching").when(low.contains("лекция"), "lecture").when(matches(text, own_line), "prayer").otherwise("material")
    )


def creation(footer_text: Column, source_path: Column) -> Column:
    """struct(date, year, raw, yearSource): the year falls back to that of the source path."""
    day = russian_date(footer_text)
    by_path = source_publication(source_path)["year"]
    return F.struct(
        day.alias("date"), F.coalesce(F.substring(day, 1, 4).cast("int"), by_path).alias("year"), F.nullif(footer_text, F.lit("")).alias("raw"),
        F.when(day.isNotNull(), "text").when(by_path.isNotNull(), "path").alias("yearSource"),
    )


def publication_line(lines: Column) -> Column:
    """struct(volume, issue, date, rawDate, raw) of the first publication line."""
    raw = first(lines, lambda x: is_publication(x))
    raw_date = capture(raw, fixed.ISSUE_DATE_CASED, 1, "u")
    return F.struct(
        capture(raw, fixed.VOLUME).cast("int").alias("volume"), F.nullif(normal_spaces(capture(raw, fixed.ISSUE)), F.lit("")).alias("issue"),
        russian_date(F.coalesce(raw_date, raw)).alias("date"), normal_spaces(raw_date).alias("rawDate"), raw.alias("raw"),
    )


def issue_of(path: Column, evidence: Column) -> Column:
    """Site publication of an issue: the path first, then the evidence lines."""
    parts = source_publication(path)
    text = F.array_join(evidence, "\n")
    return site_publication(F.coalesce(parts["year"], year_in_text(text)), F.coalesce(parts["month"], month_in_text(text)), parts["rawLabel"])


def issue_slug(path: Column, publication: Column) -> Column:
    """``YYYYQq-m`` where quarter and month fit, else the year and the file's name."""
    quarter = source_publication(path)["quarter"]
    place = publication["month"] - (quarter - 1) * 3
    canonical = F.concat(publication["year"].cast("string"), F.lit("Q"), quarter.cast("string"), F.lit("-"), place.cast("string"))
    return F.when(place.between(1, 3) & publication["year"].isNotNull(), canonical).otherwise(
        F.concat_ws("-", F.coalesce(publication["year"].cast("string"), F.lit("word")), name_slug(stem(path))))


def issue_title(label: Column) -> Column:
    return F.when(F.length(label) > 0, F.concat(F.lit(f"{fixed.SERIES_TITLE}. "), label)).otherwise(F.lit(fixed.SERIES_TITLE))


def load_publication(publication: Column, source_path: Column, json_path: Column, default_year: int) -> Column:
    """Publication to load: as parsed if complete, else from the file's quarter name, else the year alone."""
    name = r"(?:^|/)((?:19|20)\d{2})Q([1-4])-([1-3])(?:\.[^.]+)?$"
    year = F.coalesce(year_in_path(source_path), year_in_path(json_path), F.lit(default_year))
    month = (capture(source_path, name, 2).cast("int") - 1) * 3 + capture(source_path, name, 3).cast("int")
    by_name = F.when(capture(source_path, name).cast("int") == year, month)
    text = year.cast("string")
    key = F.concat_ws("-", text, pad2(by_name))
    nothing = F.lit(None).cast("string")
    derived = F.struct(
        nothing.alias("label"), nothing.alias("rawLabel"), year.alias("year"), by_name.alias("month"),
        F.when(by_name.isNotNull(), F.array(key)).otherwise(F.array().cast("array<string>")).alias("months"),
        F.when(by_name.isNotNull(), F.concat(key, F.lit("-01"))).otherwise(F.concat(text, F.lit("-01-01"))).alias("sortDate"),
    )
    complete = (publication["year"] > 0) & (F.size(publication["months"]) > 0)
    return F.when(complete, publication).otherwise(derived)
