"""Changes, streams and measures over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.operators import catalog, freshness, merged
from scriptoria.scratch import materialise, scratch_path
from scriptoria.streaming import windows

from .registering import query
from .roles import CONTAINERS, DOCUMENTS, containers, documents, table


@query(r"""WITH b AS (SELECT 'p/' || page_id AS path, sha256(coalesce(html, '')) AS d, page_id % 3 AS t FROM pages WHERE page_id % 7 <> 0),
a AS (SELECT CASE WHEN page_id % 11 = 0 THEN 'q/' ELSE 'p/' END || page_id AS path, sha256(coalesce(html, '') || CASE WHEN page_id % 13 = 0 THEN 'x' ELSE '' END) AS d, CASE WHEN page_id % 17 = 0 THEN 9 ELSE page_id % 3 END AS t FROM pages WHERE page_id % 5 <> 0),
j AS (SELECT b.path AS o, a.path AS n, b.d AS od, a.d AS nd, b.t AS ot, a.t AS nt FROM b FULL JOIN a ON a.path = b.path),
g AS (SELECT o, od AS d, row_number() OVER (PARTITION BY od ORDER BY o) AS k FROM j WHERE n IS NULL), w AS (SELECT n, nd AS d, row_number() OVER (PARTITION BY nd ORDER BY n) AS k FROM j WHERE o IS NULL)
SELECT CASE WHEN od <> nd THEN 'changed' WHEN ot <> nt THEN 'touched' ELSE 'same' END AS state, o AS "oldPath", n AS "newPath" FROM j WHERE o IS NOT NULL AND n IS NOT NULL
UNION ALL SELECT CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'gone' ELSE 'moved' END, o, n FROM g FULL JOIN w ON g.d = w.d AND g.k = w.k""")
def listing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of the pages as files: some gone, some added, some moved, some with another text or time."""
    key, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    pages = table(spark, sf_dir, "pages")
    name = lambda top: F.concat(top, key.cast("string")).alias("relativePath")
    before = pages.where(key % 7 != 0).select(name(F.lit("p/")), F.sha2(html, 256).alias("sha256"), (key % 3).alias("mtime"))
    text = F.concat(html, F.when(key % 13 == 0, "x").otherwise(""))
    after = pages.where(key % 5 != 0).select(name(F.when(key % 11 == 0, "q/").otherwise("p/")), F.sha2(text, 256).alias("sha256"), F.when(key % 17 == 0, 9).otherwise(key % 3).alias("mtime"))
    return freshness.listing_changes(before, after)


@query("SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS v FROM customer")
def merged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table merged twice; the second change touches some keys, with newer and older versions among them."""
    path = scratch_path(spark, "merged")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    merged.merge(rows.withColumn("v", F.lit(1)), path, ["c_custkey"], ["v"])
    key = F.col("c_custkey")
    newer = rows.where(key % 10 == 0).withColumn("c_mktsegment", F.when(key % 20 == 0, "moved").otherwise(F.col("c_mktsegment"))).withColumn("v", F.lit(2))
    older = rows.where(key % 10 == 1).withColumn("c_mktsegment", F.lit("stale")).withColumn("v", F.lit(0))
    merged.merge(newer.union(older), path, ["c_custkey"], ["v"])
    return merged.read(spark, path)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant; results have the wall clock again


def _closed(spark: SparkSession, found: DataFrame) -> DataFrame:
    path = scratch_path(spark, "windows")
    windows.write_closed(found, path, f"{path}-checkpoint")
    return spark.read.schema(found.schema).parquet(path)


@query("""WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events, m GROUP BY 1, 2, mark HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= mark""")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed(spark, windows.windowed_counts(_events(spark, sf_dir), "ts", "1 hour", "10 minutes", "event_type")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events), g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(ts) AS start, user_id, count(*) AS n FROM s, m GROUP BY user_id, k, mark HAVING max(ts) + INTERVAL 6 HOUR <= mark""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed(spark, windows.session_counts(_events(spark, sf_dir), "ts", "6 hours", "10 minutes", "user_id")).select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "n")


@query("""WITH g AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE p <> event_type) AS changes, arg_max(event_type, (ts, event_id)) AS event_type FROM g GROUP BY 1""")
def stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "states")
    windows.write_states(windows.key_states(_events(spark, sf_dir), "user_id", "ts", "event_id", "event_type"), path, f"{path}-checkpoint", "user_id")
    return merged.read(spark, path)


@query(f"""WITH {CONTAINERS}, {DOCUMENTS}, f AS (SELECT d.*, siteYear FROM d JOIN c ON c.slug = d.slug)
SELECT siteYear, documentType, status, count(*) AS n, (4 * grouping(siteYear) + 2 * grouping(documentType) + grouping(status))::INT AS level FROM f GROUP BY CUBE (siteYear, documentType, status)""")
def facet_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.facet_cube(containers(spark, sf_dir), documents(spark, sf_dir), ["siteYear", "documentType", "status"])


@query(f"""WITH {CONTAINERS}, {DOCUMENTS} SELECT siteYear, count(DISTINCT d.slug) AS exact, true AS near FROM d JOIN c ON c.slug = d.slug GROUP BY 1""")
def facet_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers by year, exact and from stored sketches by year and type: ``near`` says whether the two are within 3 %."""
    cont, docs = containers(spark, sf_dir), documents(spark, sf_dir)
    sketches = materialise(catalog.facet_sketches(cont, docs, ["siteYear", "documentType"], "slug"), "sketches")
    exact = docs.join(cont.select("slug", "siteYear"), "slug").groupBy("siteYear").agg(F.count_distinct("slug").alias("exact"))
    about = catalog.merged_sketches(sketches, ["siteYear"])
    return exact.join(about, "siteYear").select("siteYear", "exact", (F.abs(F.col("about") - F.col("exact")) <= 0.03 * F.col("exact")).alias("near"))


# Fixed value: the Russian alphabet.
_LETTERS = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"


@query(f"""WITH n AS (SELECT c_custkey, substr('{_LETTERS}', (c_custkey % 33)::INT + 1, 1) || substr('{_LETTERS}', (c_custkey // 5 % 33)::INT + 1, 1) || substr('{_LETTERS}', (c_custkey // 33 % 33)::INT + 1, 1) AS name FROM customer),
k AS (SELECT *, translate(replace(name, 'ё', 'е'), '{_LETTERS}', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefg') AS a, translate(name, '{_LETTERS}', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefg') AS b FROM n)
SELECT c_custkey, name, (row_number() OVER (ORDER BY a, b, c_custkey))::INT AS place FROM k""")
def russian_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the order of the Russian alphabet."""
    key = F.col("c_custkey")
    letter = lambda k: F.substring(F.lit(_LETTERS), (k % 33).cast("int") + 1, F.lit(1))
    names = table(spark, sf_dir, "customer").select("c_custkey", F.concat(letter(key), letter(F.floor(key / 5)), letter(F.floor(key / 33))).alias("name"))
    order = Window.orderBy(catalog.russian_order(F.col("name")), "c_custkey")
    return names.withColumn("place", F.row_number().over(order))
