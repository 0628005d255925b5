"""Archive sources: file listings with digests, source map, overrides and the legacy catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.functions.jsregex import trim
from scriptoria.functions.labels import slug_of_href
from scriptoria.operators.archive import listing


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """relativePath, extension, size, sha256, mtime, head of all files below ``root``, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = F.regexp_replace(F.col("path"), r"^.*?" + root.rstrip("/").replace("\\", "").replace(".", r"\.") + "/", "")
    rows = files.select(F.url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))).alias("relativePath"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("mtime"), F.substring("content", 1, 8).alias("head"))
    return listing(rows).orderBy("relativePath")


_ITEM = "struct<oldPath:string,newPath:string,year:int,quarter:int,month:int,format:string,originalName:string,extension:string,size:bigint,sha256:string>"


def source_map_items(json_rows: DataFrame, column: str = "value") -> DataFrame:
    """Items of source maps given as JSON text, with their place in the map."""
    parsed = F.from_json(F.col(column), f"items array<{_ITEM}>")
    return json_rows.select(F.posexplode(parsed["items"]).alias("item_pos", "i")).select("item_pos", "i.*")


def overrides(json_rows: DataFrame, column: str = "value") -> DataFrame:
    """path, expectedDocuments, splitBefore, titles, notes of override maps given as JSON text."""
    one = "struct<expectedDocuments:int,splitBefore:array<string>,documents:array<struct<title:string,titleAlternatives:array<string>,notes:string>>,notes:string>"
    parsed = F.from_json(F.col(column), f"files map<string,{one}>")
    rows = json_rows.select(F.explode(parsed["files"]).alias("path", "o"))
    return rows.select("path", "o.expectedDocuments", "o.splitBefore", F.transform("o.documents", lambda d: d["title"]).alias("titles"), "o.notes")


def legacy_catalog(json_rows: DataFrame, column: str = "value") -> DataFrame:
    """slug, documents (in file order, with their position): entries without href, title or year are dropped."""
    lecture = "struct<year:string,month:string,title:string,href:string,url:string,sourceFile:string,authors:array<struct<name:string,href:string>>>"
    rows = json_rows.select(F.posexplode(F.from_json(F.col(column), f"lectures array<{lecture}>")["lectures"]).alias("n", "l"))
    text = lambda c: F.nullif(trim(c), F.lit(""))
    rows = rows.select("n", *[text(F.col(f"l.{c}")).alias(c) for c in ("year", "title", "href", "url", "sourceFile")], F.coalesce(text(F.col("l.month")), F.lit("")).alias("month"), "l.authors")
    authors = F.transform(F.filter(F.coalesce("authors", F.array()), lambda a: text(a["name"]).isNotNull()), lambda a: F.struct(text(a["name"]).alias("name"), text(a["href"]).alias("href")))
    rows = rows.withColumns({"authors": authors, "slug": slug_of_href(F.col("href"))}).where("slug is not null and href is not null and title is not null and year is not null")
    rows = rows.withColumn("position", F.row_number().over(Window.partitionBy("slug").orderBy("n")))
    return rows.groupBy("slug").agg(F.sort_array(F.collect_list(F.struct("position", "year", "month", "title", "href", "url", "sourceFile", "authors"))).alias("documents"))


def legacy_reference(documents: DataFrame, legacy: DataFrame) -> DataFrame:
    """Add expectedDocuments and the legacy document at the same position (null if there is none)."""
    held = legacy.withColumnRenamed("documents", "_legacy")
    joined = documents.join(held, "slug", "left")
    return joined.withColumns({"expectedDocuments": F.when(F.col("_legacy").isNotNull(), F.size("_legacy")), "legacyDocument": F.get("_legacy", F.col("position") - 1)}).drop("_legacy")


def count_mismatches(parsed_counts: DataFrame, legacy: DataFrame) -> DataFrame:
    """slug, parsed, legacy where the numbers of documents differ."""
    joined = parsed_counts.join(legacy.select("slug", F.size("documents").alias("legacy")), "slug")
    return joined.where(F.col("parsed") != F.col("legacy")).select("slug", "parsed", "legacy")
