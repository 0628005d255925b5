"""Archive, export and load queries over the driver's tables and over inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.operators import archive as A
from scriptoria.operators import catalog, exports, load
from scriptoria.scratch import scratch_path
from scriptoria.sources import archive_files
from scriptoria.streaming import arrivals

from .registering import query
from .roles import CONTAINERS, DOCUMENTS, containers, documents, table


@query("SELECT o_orderkey AS slug, count(l_orderkey)::INT AS parsed, (o_orderkey % 7)::INT AS legacy FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 3 HAVING count(l_orderkey) <> o_orderkey % 7")
def count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("slug")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slug"))
    parsed = orders.join(lines, "slug", "left").select("slug", F.coalesce("n", F.lit(0)).alias("parsed"))
    legacy = orders.select("slug", F.when(F.col("slug") % 7 > 0, F.sequence(F.lit(1), (F.col("slug") % 7).cast("int"))).otherwise(F.array().cast("array<int>")).alias("documents"))
    return archive_files.count_mismatches(parsed, legacy)


@query("SELECT d.doc_id, l.quality, l.toxic, l.doc_id IS NOT NULL AS known FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def legacy_left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("slug"), F.array(F.struct("quality", "toxic")).alias("documents"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("slug"), F.lit(1).alias("position"))
    out = archive_files.legacy_reference(docs, legacy)
    return out.select(F.col("slug").alias("doc_id"), F.col("legacyDocument.quality").alias("quality"), F.col("legacyDocument.toxic").alias("toxic"), F.col("expectedDocuments").isNotNull().alias("known"))


@query("SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1")
def dedupe_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.ranked(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], [F.desc("n_chars"), "doc_id"]).select("source", "lang", "doc_id")


@query("SELECT md5(text) AS name, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY text HAVING count(*) > 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("name")).agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).where(F.size("ids") > 1)
    return groups.select("name", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("""WITH u AS (SELECT string_split(url || CASE WHEN page_id % 5 = 0 THEN '/X' ELSE '/x' END, '/') AS p FROM pages), s AS (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM u),
k AS (SELECT DISTINCT array_to_string(p[1 : i - 1], '/') || '/' || lower(p[i]) AS key, p[i] AS part FROM s)
SELECT key, string_agg(part, '|' ORDER BY part) AS spellings FROM k GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT 'host/' || lower(r), string_agg(DISTINCT r, '|' ORDER BY r) FROM (SELECT CASE WHEN r_regionkey % 2 = 0 THEN 'Region' ELSE 'region' END AS r FROM region) GROUP BY lower(r)""")
def case_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.concat("url", F.when(F.col("page_id") % 5 == 0, "/X").otherwise("/x")).alias("relativePath"))
    region = table(spark, sf_dir, "region").select(F.concat(F.lit("host/"), F.when(F.col("r_regionkey") % 2 == 0, "Region").otherwise("region")).alias("relativePath"))
    return A.case_conflicts(pages).union(A.case_conflicts(region)).select("key", F.array_join("spellings", "|").alias("spellings"))


@query("SELECT k AS key, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('en'), ('fr'), ('ru')) d(k) LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) ON lang = k")
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts(table(spark, sf_dir, "documents"), F.col("lang"), ["en", "fr", "ru"])


@query("SELECT url AS path, length(url)::INT AS length FROM pages ORDER BY length(url) DESC, url LIMIT 25")
def topk_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.longest_paths(table(spark, sf_dir, "pages"), 25, "url")


@query("""SELECT 'downloads/' || lang || '/' || d.doc_id || '.' || f AS path FROM documents d, (VALUES ('pdf'), ('txt'), ('docx'), ('epub')) x(f)
EXCEPT SELECT 'downloads/' || lang || '/' || d.doc_id || '.txt' FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def completeness_cross_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("year"), F.col("doc_id").cast("string").alias("slug"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("slug"))
    existing = docs.join(known, "slug", "left_semi").select(exports.export_path(F.col("year"), F.col("slug"), F.lit("txt")).alias("path"))
    return A.completeness(docs, existing)


@query("SELECT year(o_orderdate)::INT AS year, o_orderkey AS slug, f AS format, 'downloads/' || year(o_orderdate) || '/' || o_orderkey || '.' || f AS path FROM orders, (VALUES ('pdf'), ('txt'), ('docx'), ('epub')) x(f)")
def export_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.tasks(containers(spark, sf_dir).select("slug", F.col("siteYear").alias("year")))


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}
SELECT c.slug, md5(c.slug || chr(10) || chr(10) || siteYear || chr(10) || chr(10) || '' || chr(10) || chr(10) || string_agg(documentType || chr(10) || chr(10) || 'h' || position || chr(10) || chr(10) || '' || chr(10) || chr(10) || status || chr(10) || chr(10) || '' || chr(10) || chr(10) || 'f' || chr(10) || chr(10) || '', chr(10) || chr(10) ORDER BY position) || chr(10) || chr(10) || '') AS digest
FROM c JOIN d ON c.slug = d.slug GROUP BY c.slug, siteYear""")
def export_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("slug", "position", F.col("documentType").alias("documentTitle"), F.array(F.concat(F.lit("h"), F.col("position").cast("string"))).alias("header"), F.array("status").alias("body"), F.array(F.lit("f")).alias("footer"))
    issues = catalog.with_children(containers(spark, sf_dir), docs, fields=["documentTitle", "header", "body", "footer"])
    issues = issues.select("slug", F.col("siteYear").alias("year"), F.col("slug").cast("string").alias("title"), F.col("siteYear").cast("string").alias("siteLabel"), "documents")
    return exports.text_export(issues).select("slug", F.md5("text").alias("digest"))


@query()
def export_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    issue = spark.createDataFrame([("2020Q1-1", 2020, "T & U", "Январь 2020", [("Заголовок", ["h"], ["a < b"], ["f"])])], "slug string, year int, title string, siteLabel string, documents array<struct<documentTitle:string,header:array<string>,body:array<string>,footer:array<string>>>")
    both = [exports.packages(issue, k).select("slug", F.lit(k).alias("format"), F.octet_length("content").alias("bytes")) for k in ("docx", "epub")]
    return both[0].union(both[1])


@query(f"""WITH {CONTAINERS}, {DOCUMENTS} SELECT 'repeated slug' AS "check", 0::BIGINT AS n UNION ALL SELECT 'repeated id', 0 UNION ALL SELECT 'repeated position', 0 UNION ALL SELECT 'orphan', 0
UNION ALL SELECT 'count', count(*) FROM (SELECT c.slug, count(d.slug) AS n FROM c LEFT JOIN d ON c.slug = d.slug GROUP BY 1) WHERE n <> 4""")
def load_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("id", F.concat_ws("-", "slug", "position"))
    return load.problems(containers(spark, sf_dir).withColumn("documentsCount", F.lit(4)), docs)


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def arrivals_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    path = scratch_path(spark, "arrivals")
    arrivals.run_available(stream, path, f"{path}-checkpoint", ["user_id"], ["ts", "event_id"])
    return arrivals.current(spark, path).select("user_id", "event_id", "event_type")


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 10 = 0")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    older = old.withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_acctbal")))
    return load.changed_only(older, old, ["c_custkey"])


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) <= 50 AS inBudget FROM orders WHERE year(o_orderdate) = 1995
UNION ALL SELECT o_orderkey, false FROM orders WHERE year(o_orderdate) > 1995""")
def budget_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scriptoria.operators.enrich import budgeted

    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"), F.lit(True).alias("needs"))
    return budgeted(rows, "needs", ["o_orderdate", "o_orderkey"], 50, block="y").select("o_orderkey", "inBudget")
