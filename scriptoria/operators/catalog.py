"""Catalog queries: facets, semi-joins, nested listings, groups, detail, links.

Tables: ``containers`` (slug, title, siteLabel, siteYear, siteMonth, siteSortDate, documentsCount, ...) and
``documents`` (slug, position, documentTitle, documentType, authorName, authorSlug, creationYear, ...).
Filters are built on the driver; each query is one lazy plan.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import fixed
from scriptoria.functions.authors import display_author
from scriptoria.functions.dates import long_date, site_label
from scriptoria.functions.labels import CATALOG_KEYS, OFFLINE_KEYS, filter_href, filter_href_column, part_title, type_label


def optional_text(value: str | None) -> str | None:
    """Trimmed text, None if blank."""
    t = (value or "").strip()
    return t or None


def positive_integer(value: str | None) -> int | None:
    """A positive whole number in any form that a number may be written in (``2e3``, ``0x7db``, `` 2011 ``), else None."""
    t = (value or "").strip()
    try:
        number = float(int(t, 0)) if t[:2].lower() in ("0x", "0o", "0b") else float(t.replace("_", "x"))
    except ValueError:
        return None
    return int(number) if math.isfinite(number) and number > 0 and number == int(number) else None


def first_value(value: str | Iterable[str] | None) -> str | None:
    """First value of a repeated parameter."""
    return value if value is None or isinstance(value, str) else next(iter(value), None)


@dataclass(frozen=True)
class Filters:
    """Facets of the catalog; None is no filter."""

    siteYear: int | None = None  # noqa: N815
    authorSlug: str | None = None  # noqa: N815
    documentType: str | None = None  # noqa: N815
    q: str | None = None
    creationYear: int | None = None  # noqa: N815

    @staticmethod
    def of(siteYear=None, authorSlug=None, documentType=None, q=None, creationYear=None) -> Filters:  # noqa: N803
        """From raw parameters: repeated, blank and malformed values are cleaned."""
        one = first_value
        return Filters(positive_integer(one(siteYear)), optional_text(one(authorSlug)), optional_text(one(documentType)), optional_text(one(q)), positive_integer(one(creationYear)))

    def document_predicate(self) -> Column | None:
        wanted = {"authorSlug": self.authorSlug, "documentType": self.documentType, "creationYear": self.creationYear}
        return all_of([F.col(k) == v for k, v in wanted.items() if v is not None])

    def container_predicate(self) -> Column | None:
        return None if self.siteYear is None else F.col("siteYear") == self.siteYear

    def links(self) -> dict:
        return {k: getattr(self, k) for k in CATALOG_KEYS}

    def offline_links(self) -> dict:
        return {"author": self.authorSlug, "siteYear": self.siteYear, "creationYear": self.creationYear, "documentType": self.documentType}


def all_of(predicates: list[Column]) -> Column | None:
    return reduce(and_, predicates) if predicates else None


def where(df: DataFrame, predicate: Column | None) -> DataFrame:
    """Filter, or nothing without a predicate."""
    return df if predicate is None else df.where(predicate)


def in_sets(df: DataFrame, **sets: Iterable) -> DataFrame:
    """Composite filter: every non-empty set restricts its column, an empty one is no filter."""
    chosen = {k: list(v) for k, v in sets.items()}
    return where(df, all_of([F.col(k).isin(*v) for k, v in chosen.items() if v]))


def with_children(containers: DataFrame, documents: DataFrame, key: str = "slug", how: str = "inner", fields: list[str] | None = None) -> DataFrame:
    """Containers with their documents as an array ordered by position (all fields but the key)."""
    fields = fields or [c for c in documents.columns if c not in (key, "position")]
    nested = documents.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", *[f for f in fields if f != "position"]))).alias("documents"))
    return containers.join(nested, key, how)


def children_of(documents: DataFrame, chosen: DataFrame, filters: Filters) -> DataFrame:
    """Where a filter chooses containers, their documents alone: others are neither shuffled nor nested."""
    if filters.siteYear is None:
        return documents
    return documents.join(chosen.select("slug"), "slug", "left_semi")


def catalog(containers: DataFrame, documents: DataFrame, filters: Filters, matched: DataFrame | None = None) -> DataFrame:
    """Online listing: containers with a matching document, holding only their matching documents, oldest first.

    ``matched`` has the keys (slug, position) of a text search; no key means no row.
    """
    found = where(documents, filters.document_predicate())
    if matched is not None:
        found = found.join(matched.select("slug", "position").distinct(), ["slug", "position"], "left_semi")
    chosen = where(containers, filters.container_predicate())
    return with_children(chosen, children_of(found, chosen, filters)).orderBy("siteSortDate", "slug")


def offline_catalog(containers: DataFrame, documents: DataFrame, filters: Filters) -> DataFrame:
    """Offline listing: containers with a matching document hold all their documents, newest first."""
    chosen = where(containers, filters.container_predicate())
    wanted = filters.document_predicate()
    if wanted is not None:
        chosen = chosen.join(documents.where(wanted).select("slug").distinct(), "slug", "left_semi")
    return with_children(chosen, children_of(documents, chosen, filters), how="left").orderBy(F.desc("siteSortDate"), F.desc("slug"))


def detail(containers: DataFrame, documents: DataFrame, site_year: int, slug: str) -> DataFrame:
    """One container with its documents; no row if there is none."""
    one = containers.where((F.col("siteYear") == site_year) & (F.col("slug") == slug))
    return with_children(one, documents.where(F.col("slug") == slug), how="left")


def distinct_years(containers: DataFrame, filters: Filters = Filters()) -> DataFrame:  # noqa: B008
    """Years in order, with the link that chooses each."""
    years = containers.select("siteYear").distinct()
    return years.select("siteYear", filter_href_column(filters.links(), CATALOG_KEYS, "siteYear", F.col("siteYear")).alias("href")).orderBy("siteYear")


def year_month_groups(listing: DataFrame) -> DataFrame:
    """Two-level groups of a listing (siteYear, siteMonth, siteLabel, siteSortDate, slug): year, months(label, slugs).

    Groups keep the order in which the listing first meets them.
    """
    label = F.when(F.col("siteMonth") > 0, site_label(F.col("siteLabel"), F.col("siteYear"), F.col("siteMonth"))).otherwise(F.col("siteYear").cast("string"))
    rows = listing.select("siteYear", label.alias("label"), F.struct("siteSortDate", "slug").alias("o"))
    months = rows.groupBy("siteYear", "label").agg(F.min("o").alias("o"), F.transform(F.sort_array(F.collect_list("o")), lambda x: x["slug"]).alias("slugs"))
    years = months.groupBy("siteYear").agg(F.min("o").alias("o"), F.sort_array(F.collect_list(F.struct("o", "label", "slugs"))).alias("m"))
    return years.orderBy("o").select("siteYear", F.transform("m", lambda x: F.struct(x["label"].alias("label"), x["slugs"].alias("slugs"))).alias("months"))


def contained_documents(documents: DataFrame, filters: Filters) -> DataFrame:
    """Documents as a listing shows them."""
    links = filters.links()
    return documents.select(
        "slug", "position", display_author(F.col("authorName")).alias("author"),
        F.when(F.length("authorSlug") > 0, filter_href_column(links, CATALOG_KEYS, "authorSlug", F.col("authorSlug"))).alias("authorHref"), F.col("documentTitle").alias("title"),
        part_title(F.col("header"), F.col("documentTitle")).alias("partTitle"), "documentType", filter_href_column(links, CATALOG_KEYS, "documentType", F.col("documentType")).alias("typeHref"),
        type_label(F.col("documentType")).alias("typeLabel"), F.array_join("header", " · ").alias("rawHeader"), "description",
    )


def catalog_items(containers: DataFrame, documents: DataFrame, filters: Filters) -> DataFrame:
    """Listing items: path, labels, description, contained documents and export links."""
    chosen = where(containers, filters.container_predicate())
    shown = children_of(where(documents, filters.document_predicate()), chosen, filters)
    rows = with_children(chosen, contained_documents(shown, filters))
    year = F.col("siteYear").cast("string")
    label = site_label(F.col("siteLabel"), F.col("siteYear"), F.col("siteMonth"))
    exports = F.struct(*[F.concat(F.lit("/downloads/"), year, F.lit("/"), "slug", F.lit(f".{k}")).alias(k) for k in fixed.EXPORT_FORMATS])
    return rows.select(
        F.concat(F.lit(fixed.PAGE_PATH), year, F.lit("/"), "slug").alias("path"), "siteYear", "siteMonth", label.alias("siteMonthLabel"),
        F.coalesce(F.get("documents", F.lit(0))["description"], label).alias("description"), "documents", exports.alias("downloads"), "siteSortDate", "slug",
    ).orderBy("siteSortDate", "slug")


def offline_items(containers: DataFrame, documents: DataFrame, filters: Filters) -> DataFrame:
    """Offline items: the first document's facets as links, sums over all documents, source type."""
    links = filters.offline_links()
    rows = offline_catalog(containers, documents, filters)
    one = F.get("documents", F.lit(0))
    kind = F.coalesce(one["documentType"], F.lit("material"))
    href = lambda k, v: filter_href_column(links, OFFLINE_KEYS, k, v)
    return rows.select(
        "slug", "siteYear", "title", "documentsCount", F.when(F.size("documents") == 1, one).alias("singleDocument"), F.when(F.col("sourceWord").isNotNull(), "word").otherwise("pdf").alias("sourceType"),
        F.when((F.length(one["authorName"]) > 0) & (F.length(one["authorSlug"]) > 0), F.struct(one["authorName"].alias("label"), href("author", one["authorSlug"]).alias("href"))).alias("author"),
        F.when(one["creationYear"] > 0, F.struct(one["creationYear"].cast("string").alias("label"), href("creationYear", one["creationYear"]).alias("href"))).alias("creation"),
        F.struct(type_label(kind).alias("label"), href("documentType", kind).alias("href")).alias("documentType"),
        F.coalesce(long_date(one["creationDate"]), one["creationYear"].cast("string")).alias("creationLabel"),
        F.aggregate(F.coalesce("documents", F.array()), F.lit(0).cast("long"), lambda s, d: s + F.coalesce(d["paragraphsCount"], F.lit(0))).alias("paragraphs"),
        F.flatten(F.transform("documents", lambda d: F.filter(F.split(d["content"], "\n{2,}"), lambda t: F.length(F.trim(t)) > 0))).alias("body"),
    )


def sitemap_paths(containers: DataFrame) -> DataFrame:
    """``/`` and every container's path, newest first (column ``rank`` keeps the order)."""
    rows = containers.select(F.concat(F.lit(fixed.PAGE_PATH), F.col("siteYear").cast("string"), F.lit("/"), F.col("slug")).alias("path"), "siteSortDate", "slug")
    root = containers.sparkSession.range(1).select(F.lit("/").alias("path"), F.lit("9999-99-99").alias("siteSortDate"), F.lit("~").alias("slug"))
    return root.union(rows).orderBy(F.desc("siteSortDate"), F.desc("slug")).select("path")


def author_label(containers: DataFrame, documents: DataFrame) -> DataFrame:
    """For each author slug its label: that of the first document in catalog order, else the slug."""
    rows = documents.where(F.length("authorSlug") > 0).join(containers.select("slug", "siteSortDate"), "slug")
    first = F.min_by("authorName", F.struct("siteSortDate", "slug", "position"))
    return rows.groupBy("authorSlug").agg(F.coalesce(display_author(first), F.first("authorSlug")).alias("label"))


def active_filters(filters: Filters, author: str | None = None) -> list[dict]:
    """Chips of the chosen filters in order; each link leaves its own filter out (made on the driver)."""
    shown = {
        "siteYear": f"Год сайта: {filters.siteYear}", "authorSlug": f"Владыка: {author or filters.authorSlug}",
        "documentType": f"Тип: {fixed.TYPE_LABELS.get(filters.documentType or '', filters.documentType)}", "q": f"Поиск: {filters.q}",
    }
    links = filters.links()
    return [{"label": shown[k], "href": filter_href(links, CATALOG_KEYS, {k: None}), "value": str(links[k])} for k in CATALOG_KEYS if links[k]]


def facet_rollup(containers: DataFrame, documents: DataFrame) -> DataFrame:
    """Extension: numbers of documents by year and type, with all subtotals."""
    joined = documents.join(containers.select("slug", "siteYear"), "slug")
    return joined.rollup("siteYear", "documentType").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def facet_cube(containers: DataFrame, documents: DataFrame, facets: list[str]) -> DataFrame:
    """Extension: numbers of documents by every combination of facets; ``level`` has a bit for each facet that is summed over."""
    joined = documents.join(containers.select("slug", "siteYear"), "slug")
    return joined.cube(*facets).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def facet_sketches(containers: DataFrame, documents: DataFrame, facets: list[str], column: str, size: int = 14) -> DataFrame:
    """Extension: a sketch of the different values of ``column`` for each combination of facets: to be stored, and merged by ``merged_sketches``."""
    joined = documents.join(containers.select("slug", "siteYear"), "slug")
    return joined.groupBy(*facets).agg(F.hll_sketch_agg(column, size).alias("sketch"))


def merged_sketches(sketches: DataFrame, facets: list[str]) -> DataFrame:
    """About how many different values there are by fewer facets, from stored sketches alone (standard error 0.8 % at size 14)."""
    return sketches.groupBy(*facets).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def russian_order(text: Column) -> Column:
    """Sort key of a Russian text: by the alphabet, ``ё`` with ``е`` (behind it where nothing else differs), case last."""
    return F.collate(text, "ru")


def ranked(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Preference: the first row of each group in the given order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")
