"""Labels, links and other values that the catalog shows."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .jsregex import first, matches, normal_spaces, trim

CATALOG_KEYS = ["siteYear", "authorSlug", "documentType", "q"]
OFFLINE_KEYS = ["author", "siteYear", "creationYear", "documentType"]


def type_label(code: Column) -> Column:
    """Label of a document type; unknown codes label themselves."""
    table = F.create_map(*[F.lit(x) for pair in fixed.TYPE_LABELS.items() for x in pair])
    return F.coalesce(table[code], code)


def part_title(header: Column, title: Column | None = None) -> Column:
    """The header's own part line, unless the title already holds it."""
    part = first(header, lambda x: matches(trim(x), fixed.PART_ONLY))
    if title is None:
        return part
    held = F.lower(normal_spaces(title)).contains(F.lower(normal_spaces(part)))
    return F.when(~F.coalesce(held, F.lit(False)), part)


def strings_only(json_text: Column) -> Column:
    """The strings of a JSON array; other elements, and other values than arrays, are dropped."""
    items = F.try_parse_json(json_text)
    raw = F.from_json(json_text, "array<variant>")
    kept = F.transform(F.filter(raw, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: v.cast("string"))
    return F.when(items.isNotNull() & (F.substring(F.schema_of_variant(items), 1, 5) == "ARRAY"), kept).otherwise(F.array().cast("array<string>"))


def filter_href(filters: dict, keys: list[str], overrides: dict | None = None) -> str:
    """Link of a set of filters in a fixed order of keys; null and empty values are dropped (made on the driver)."""
    chosen = {k: filters.get(k) for k in keys} | (overrides or {})
    query = urlencode({k: v for k, v in chosen.items() if v is not None and v != ""})
    return f"/?{query}" if query else "/"


def filter_href_column(filters: dict, keys: list[str], key: str, value: Column) -> Column:
    """The same link with one key taken from a column."""
    parts = []
    for k in keys:
        if k == key:
            parts.append(F.when(F.length(value.cast("string")) > 0, F.concat(F.lit(f"{k}="), F.url_encode(value.cast("string")))))
        elif filters.get(k) not in (None, ""):
            parts.append(F.lit(urlencode({k: filters[k]})))
    query = F.concat_ws("&", *parts)
    return F.when(F.length(query) > 0, F.concat(F.lit("/?"), query)).otherwise(F.lit("/"))


def slug_of_href(href: Column) -> Column:
    """Last path segment without its extension."""
    name = F.regexp_extract(F.regexp_replace(href, "/+$", ""), "([^/]*)$", 1)
    return F.nullif(F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1"), F.lit(""))


def read_string(c: Column) -> Column:
    return F.nullif(trim(c), F.lit(""))


def creation_label(raw: Column, date: Column, year: Column) -> Column:
    return F.coalesce(F.nullif(raw, F.lit("")), F.nullif(date, F.lit("")), year.cast("string"))


def display_title(title: Column, raw_header: Column) -> Column:
    return F.coalesce(F.concat(F.lit("«"), title, F.lit("»")), raw_header)


def shown_header(header: Column, page_title: Column) -> Column:
    """Header lines of a page without its own title and the series name."""
    return F.filter(header, lambda x: ~(x.eqNullSafe(page_title) | x.startswith(fixed.SERIES_TITLE)))


def issue_parts(slug: Column) -> Column:
    """struct(slug, year, quarter) of a slug; a malformed one is an error."""
    t = trim(slug)
    good = matches(t, fixed.CANONICAL_STEM, "u")
    checked = F.when(good, t).otherwise(F.raise_error(F.concat(F.lit("invalid issue slug: "), F.coalesce(slug, F.lit("null")))).cast("string"))
    return F.struct(checked.alias("slug"), F.substring(checked, 1, 4).cast("int").alias("year"), F.substring(checked, 6, 1).cast("int").alias("quarter"))


def parsed_path(slug: Column, year: Column) -> Column:
    """Path of a parsed issue."""
    return F.concat(F.lit("data/parsed/"), year.cast("string"), F.lit("/"), slug, F.lit(".json"))


def material_matches(materials: Column, query: str | None = None, master: str | None = None, year: str | None = None) -> Column:
    """Whether one and the same material has the query in any of its fields, the master and the year."""
    def one(m: Column) -> Column:
        out = F.lit(True)
        if query:
            fields = F.lower(F.concat_ws(" ", m["title"], m["master"], m["type"], m["date"]))
            out = out & fields.contains(query.lower())
        if master:
            out = out & m["master"].eqNullSafe(F.lit(master))
        return out & m["year"].eqNullSafe(F.lit(year)) if year else out

    return F.exists(materials, one)
