"""Catalog queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import labels
from scriptoria.functions.dates import month_name, site_label
from scriptoria.operators import catalog as C
from scriptoria.operators import colocated
from scriptoria.scratch import scratch_path

from .registering import query
from .roles import CONTAINERS, DOCUMENTS, containers, documents, table

_MONTHS = "['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь','Ноябрь','Декабрь']"
_LABEL = f"{_MONTHS}[siteMonth] || ' ' || siteYear"


def _children(field: str = "status"):
    return F.array_join(F.transform("documents", lambda d: F.concat_ws(":", d["position"].cast("string"), d[field].cast("string"))), ",").alias("children")


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}
SELECT c.slug, c.siteYear, {_LABEL} AS month_label, string_agg(position || ':' || status, ',' ORDER BY position) AS children, count(*) AS n
FROM c JOIN d ON c.slug = d.slug WHERE siteYear = 1995 AND documentType = 'R' GROUP BY 1, 2, 3""")
def catalog_filtered_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.catalog(containers(spark, sf_dir), documents(spark, sf_dir), C.Filters.of(siteYear="1995", documentType="R"))
    return found.select("slug", "siteYear", site_label(F.col("siteLabel"), F.col("siteYear"), F.col("siteMonth")).alias("month_label"), _children(), F.size("documents").cast("long").alias("n"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, m AS (SELECT DISTINCT slug FROM d WHERE documentType = 'A' AND creationYear = 1997)
SELECT c.slug, string_agg(position || ':' || documentType, ',' ORDER BY position) AS children, sum(paragraphsCount)::BIGINT AS paragraphs
FROM c JOIN m ON c.slug = m.slug JOIN d ON c.slug = d.slug WHERE siteYear = 1997 GROUP BY 1""")
def catalog_all_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.offline_catalog(containers(spark, sf_dir), documents(spark, sf_dir), C.Filters(siteYear=1997, documentType="A", creationYear=1997))
    return found.select("slug", _children("documentType"), F.aggregate("documents", F.lit(0).cast("long"), lambda s, d: s + d["paragraphsCount"]).alias("paragraphs"))


_STORES: dict[tuple[str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str) -> colocated.Store:
    """The catalog in buckets by slug within years: written once a session and folder, then read by every query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        path = scratch_path(spark, "colocated")
        colocated.write(containers(spark, sf_dir), documents(spark, sf_dir), path, buckets=16)
        _STORES[key] = path
    return colocated.open_store(spark, _STORES[key])


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}
SELECT c.slug, siteYear, string_agg(position || ':' || status, ',' ORDER BY position) AS children FROM c JOIN d ON c.slug = d.slug WHERE siteYear = 1996 AND documentType = 'N' GROUP BY 1, 2""")
def colocated_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).catalog(C.Filters(siteYear=1996, documentType="N")).select("slug", "siteYear", _children())


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, m AS (SELECT DISTINCT slug FROM d WHERE documentType = 'R')
SELECT c.slug, siteYear, string_agg(position || ':' || documentType, ',' ORDER BY position) AS children, sum(paragraphsCount)::BIGINT AS paragraphs FROM c JOIN m ON c.slug = m.slug JOIN d ON c.slug = d.slug GROUP BY 1, 2""")
def colocated_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _store(spark, sf_dir).offline_catalog(C.Filters(documentType="R"))
    return found.select("slug", "siteYear", _children("documentType"), F.aggregate("documents", F.lit(0).cast("long"), lambda s, d: s + d["paragraphsCount"]).alias("paragraphs"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}
SELECT c.slug, siteYear, string_agg(position || ':' || authorSlug, ',' ORDER BY position) AS children FROM c LEFT JOIN d ON c.slug = d.slug WHERE c.slug = (SELECT max(slug) FROM c WHERE siteYear = 1999) GROUP BY 1, 2""")
def colocated_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir)
    slug = store.containers.where("siteYear = 1999").agg(F.max("slug")).first()[0]
    return store.detail(1999, slug).select("slug", "siteYear", _children("authorSlug"))


@query(f"WITH {CONTAINERS} SELECT count(*) AS n FROM c WHERE false")
def catalog_empty_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return C.catalog(containers(spark, sf_dir), docs, C.Filters(), matched=docs.where("false")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}
SELECT c.slug, siteYear, string_agg(position || ':' || authorSlug, ',' ORDER BY position) AS children FROM c LEFT JOIN d ON c.slug = d.slug
WHERE c.slug = (SELECT min(slug) FROM c WHERE siteYear = 1996) GROUP BY 1, 2""")
def detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cont = containers(spark, sf_dir)
    slug = cont.where("siteYear = 1996").agg(F.min("slug")).first()[0]
    return C.detail(cont, documents(spark, sf_dir), 1996, slug).select("slug", "siteYear", _children("authorSlug"))


@query(f"WITH {CONTAINERS} SELECT DISTINCT siteYear, '/?siteYear=' || siteYear || '&documentType=R' AS href FROM c")
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.distinct_years(containers(spark, sf_dir), C.Filters(documentType="R"))


@query(f"""WITH {CONTAINERS}, g AS (SELECT siteYear, {_LABEL} AS label, min(siteSortDate) AS o, count(*) AS n, md5(string_agg(slug::VARCHAR, ',' ORDER BY siteSortDate, slug)) AS h FROM c GROUP BY 1, 2)
SELECT siteYear, string_agg(label, ';' ORDER BY o) AS labels, string_agg(n::VARCHAR, ';' ORDER BY o) AS sizes, md5(string_agg(h, ';' ORDER BY o)) AS digest FROM g GROUP BY 1""")
def year_month_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda f: F.array_join(F.transform("months", f), ";")
    return C.year_month_groups(containers(spark, sf_dir)).select(
        "siteYear", joined(lambda m: m["label"]).alias("labels"), joined(lambda m: F.size(m["slugs"]).cast("string")).alias("sizes"),
        F.md5(joined(lambda m: F.md5(F.array_join(F.transform(m["slugs"], lambda s: s.cast("string")), ",")))).alias("digest"))


@query(f"WITH {CONTAINERS} SELECT '/' AS path UNION ALL SELECT '/pearls/' || siteYear || '/' || slug FROM c")
def sitemap_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sitemap_paths(containers(spark, sf_dir).withColumn("slug", F.col("slug").cast("string")))


@query("""SELECT l_returnflag AS code, CASE l_returnflag WHEN 'R' THEN 'R' ELSE l_returnflag END AS label, CASE WHEN l_linestatus = 'O' THEN 'Лекция' ELSE 'unknown' END AS other, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    code = F.when(F.col("l_linestatus") == "O", "lecture").otherwise("unknown")
    return rows.groupBy(F.col("l_returnflag").alias("code"), labels.type_label(F.col("l_returnflag")).alias("label"), labels.type_label(code).alias("other")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS} SELECT authorSlug::VARCHAR AS authorSlug, arg_min(s_name, (siteSortDate, slug, position)) AS label
FROM (SELECT d.authorSlug, c.siteSortDate, d.slug, d.position, s_name FROM d JOIN c ON c.slug = d.slug JOIN supplier ON s_suppkey = d.authorSlug) GROUP BY 1""")
def author_first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("authorSlug"), F.col("s_name").alias("authorName"))
    docs = documents(spark, sf_dir).join(names, "authorSlug").withColumn("authorSlug", F.col("authorSlug").cast("string"))
    return C.author_label(containers(spark, sf_dir), docs)


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, f AS (SELECT d.*, siteYear FROM d JOIN c ON c.slug = d.slug)
SELECT siteYear, documentType, count(*) AS n, (grouping(siteYear) * 2 + grouping(documentType))::INT AS level FROM f GROUP BY ROLLUP (siteYear, documentType)""")
def facet_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.facet_rollup(containers(spark, sf_dir), documents(spark, sf_dir))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS} SELECT slug, position, authorSlug, '/?siteYear=1995&authorSlug=' || authorSlug || '&q=a+b' AS author_href, '/?siteYear=1995&documentType=' || documentType || '&q=a+b' AS type_href
FROM d""")
def filter_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = C.Filters(siteYear=1995, q="a b").links()
    docs = documents(spark, sf_dir)
    return docs.select("slug", "position", "authorSlug", labels.filter_href_column(links, labels.CATALOG_KEYS, "authorSlug", F.col("authorSlug")).alias("author_href"),
                       labels.filter_href_column(links, labels.CATALOG_KEYS, "documentType", F.col("documentType")).alias("type_href"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, s AS (SELECT c.slug, siteYear, siteSortDate, count(d.slug)::INT AS documentsCount, coalesce(sum(paragraphsCount), 0)::BIGINT AS paragraphs, arg_min(d.documentType, d.position) AS first_type,
 string_agg(d.documentType, ' · ' ORDER BY d.position) AS header FROM c LEFT JOIN d ON c.slug = d.slug WHERE siteYear = 1998 GROUP BY 1, 2, 3)
SELECT slug, documentsCount, paragraphs, coalesce(first_type, 'material') AS first_type, documentsCount = 1 AS single, coalesce(header, '') AS header FROM s""")
def offline_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.offline_catalog(containers(spark, sf_dir), documents(spark, sf_dir), C.Filters(siteYear=1998))
    docs = F.coalesce("documents", F.array())
    return rows.select(
        "slug", F.size(docs).alias("documentsCount"), F.aggregate(docs, F.lit(0).cast("long"), lambda s, d: s + d["paragraphsCount"]).alias("paragraphs"),
        F.coalesce(F.get(docs, F.lit(0))["documentType"], F.lit("material")).alias("first_type"), (F.size(docs) == 1).alias("single"), F.array_join(F.transform(docs, lambda d: d["documentType"]), " · ").alias("header"))


def _shown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Containers and inner documents with all columns that listings show."""
    cont = containers(spark, sf_dir).withColumn("slug", F.col("slug").cast("string"))
    cont = cont.withColumns({"title": F.concat(F.lit("C"), "slug"), "documentsCount": F.lit(4), "sourceWord": F.when(F.col("siteMonth") % 2 == 0, "w.doc")})
    signed, number = F.col("status") == "O", F.col("authorSlug").cast("string")
    kind = F.when(F.col("documentType") == "R", "lecture").when(F.col("documentType") == "A", "prayer").otherwise("odd")
    docs = documents(spark, sf_dir).select(
        F.col("slug").cast("string").alias("slug"), "position", F.when(signed, F.concat(F.lit("Имя "), number)).alias("authorName"), F.when(signed, F.concat(F.lit("a"), number)).otherwise("").alias("authorSlug"),
        F.concat(F.lit("T"), "position").alias("documentTitle"), kind.alias("documentType"), F.concat(F.lit("D"), "position").alias("description"), F.array(F.concat(F.lit("H"), "paragraphsCount"), F.lit("Часть II")).alias("header"),
        "creationYear", F.when(F.col("position") % 2 == 0, F.to_date(F.lit("1970-02-01"))).alias("creationDate"), F.concat(F.lit("a"), "paragraphsCount", F.lit("\n\n \n\nb")).alias("content"), "paragraphsCount")
    return cont, docs


_SHOWN = "x AS (SELECT *, CASE WHEN status = 'O' THEN 'Имя ' || authorSlug END AS name, CASE WHEN status = 'O' THEN 'a' || authorSlug END AS mark, CASE documentType WHEN 'R' THEN 'lecture' WHEN 'A' THEN 'prayer' ELSE 'odd' END AS kind, CASE documentType WHEN 'R' THEN 'Лекция' WHEN 'A' THEN 'Молитва' ELSE 'odd' END AS kindLabel FROM d)"


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, {_SHOWN}
SELECT c.slug::VARCHAR AS slug, '/pearls/1997/' || c.slug AS path, {_LABEL} AS label, 'D1' AS description, '/downloads/1997/' || c.slug || '.epub' AS epub,
string_agg(concat_ws('|', name, '/?siteYear=1997&authorSlug=' || mark, 'T' || position, 'Часть II', '/?siteYear=1997&documentType=' || kind, kindLabel, 'H' || paragraphsCount || ' · Часть II'), ';' ORDER BY position) AS documents
FROM c JOIN x ON x.slug = c.slug WHERE siteYear = 1997 GROUP BY c.slug, siteYear, siteMonth""")
def listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.catalog_items(*_shown(spark, sf_dir), C.Filters(siteYear=1997))
    one = lambda d: F.concat_ws("|", *[d[c] for c in ("author", "authorHref", "title", "partTitle", "typeHref", "typeLabel", "rawHeader")])
    return rows.select("slug", "path", F.col("siteMonthLabel").alias("label"), "description", F.col("downloads.epub").alias("epub"), F.array_join(F.transform("documents", one), ";").alias("documents"))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, {_SHOWN}, n AS (SELECT slug, sum(paragraphsCount)::BIGINT AS paragraphs, string_agg('a' || paragraphsCount || '|b', '|' ORDER BY position) AS body FROM x GROUP BY 1)
SELECT c.slug::VARCHAR AS slug, CASE WHEN siteMonth % 2 = 0 THEN 'word' ELSE 'pdf' END AS source, name AS author, '/?author=' || mark || '&siteYear=1998' AS author_href, '/?siteYear=1998&creationYear=' || creationYear AS year_href, coalesce(kindLabel, 'Материал') AS type,
'/?siteYear=1998&documentType=' || coalesce(kind, 'material') AS type_href, creationYear::VARCHAR AS created, coalesce(paragraphs, 0)::BIGINT AS paragraphs, body
FROM c LEFT JOIN (SELECT * FROM x WHERE position = 1) f ON f.slug = c.slug LEFT JOIN n ON n.slug = c.slug WHERE siteYear = 1998""")
def offline_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.offline_items(*_shown(spark, sf_dir), C.Filters(siteYear=1998))
    return rows.select("slug", F.col("sourceType").alias("source"), F.col("author.label").alias("author"), F.col("author.href").alias("author_href"), F.col("creation.href").alias("year_href"), F.col("documentType.label").alias("type"),
                       F.col("documentType.href").alias("type_href"), F.col("creationLabel").alias("created"), "paragraphs", F.array_join("body", "|").alias("body"))


@query("SELECT o_orderkey, ['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь','Ноябрь','Декабрь'][month(o_orderdate)] AS month, year(o_orderdate) || 'Q' || quarter(o_orderdate) || '-' || ((month(o_orderdate) - 1) % 3 + 1) AS slug FROM orders")
def quarter_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scriptoria.functions.dates import site_publication
    from scriptoria.functions.publication import issue_slug

    day = F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.year(day).alias("y"), F.quarter(day).alias("q"), F.month(day).alias("m"))
    rows = rows.withColumns({"path": F.concat_ws("/", F.lit("src"), F.col("y").cast("string"), F.concat(F.lit("Q"), F.col("q").cast("string")), F.lit("word/a.doc")), "pub": site_publication(F.col("y"), F.col("m"), F.lit(None).cast("string"))})
    return rows.select("o_orderkey", month_name(F.col("m")).alias("month"), issue_slug(F.col("path"), F.col("pub")).alias("slug"))


@query("""WITH t AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer)
SELECT c_custkey FROM t WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 3, 5, 7)""")
def composite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.in_sets(table(spark, sf_dir, "customer"), c_mktsegment=["BUILDING", "MACHINERY"], c_nationkey=[1, 3, 5, 7], c_custkey=[]).select("c_custkey")
