"""Parsed issues as JSON: explicit schema, file filters, and errors that say what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PARAGRAPH = "struct<text:string,styleId:string,isBold:boolean,isItalic:boolean,maxFontSize:double,boldTextRatio:double>"
_INNER = (
    "struct<documentTitle:string,documentType:string,author:struct<name:string,slug:string,raw:string>,creation:struct<date:string,year:int,raw:string>,"
    "pearlPublication:struct<volume:int,issue:string,date:string,rawDate:string,raw:string>,"
    f"parts:struct<header:array<string>,body:array<{_PARAGRAPH}>,footer:array<{_PARAGRAPH}>>>"
)
SCHEMA = (
    "slug string, title string, sitePublication struct<label:string,rawLabel:string,year:int,month:int,months:array<string>,sortDate:string>, documentsCount int, "
    f"documents array<{_INNER}>, sourcePdf string, sourceWord string, preparedDocx string, jsonPath string, parsedAt string, meta struct<pages:int,layout:string>"
)


def read_issues(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """All issues below ``path``; files named ``*_OLD.json`` and ``package.json`` are left out.

    With ``strict`` a file that is not JSON is an error, else its fields are null.
    """
    reader = spark.read.schema(SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "FAILFAST" if strict else "PERMISSIVE")
    name = F.col("_metadata.file_name")
    return reader.json(path).where(~F.rlike(name, F.lit(r"(?i)_OLD\.json$")) & (F.lower(name) != "package.json"))


def issues_of(spark: SparkSession, path: str, year: int | None = None, slug: str | None = None) -> DataFrame:
    """Issues of a year and slug, by slug; a slug that is not there is an error."""
    found = read_issues(spark, path)
    if year is not None:
        found = found.where(F.coalesce("sitePublication.year", F.regexp_extract(F.coalesce("jsonPath", F.lit("")), r"(?:^|/)((?:19|20)\d{2})(?:/|$)", 1).try_cast("int")) == year)
    if slug is not None:
        found = found.where(F.col("slug") == slug)
        if found.isEmpty():
            raise LookupError(f"no issue {slug}")
    elif year is not None and found.isEmpty():
        years = [r[0] for r in read_issues(spark, path).select("sitePublication.year").distinct().orderBy("year").limit(100).collect()]
        raise LookupError(f"no issues of {year}; there are {', '.join(map(str, years)) or 'none'}")
    return found.orderBy("slug")


def write_issues(issues: DataFrame, path: str) -> None:
    """One JSON line an issue, in a folder of its own: only the issues given are replaced, all others below ``path`` stay."""
    issues.withColumn("issue", F.col("slug")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue").json(path)


def pretty(issues: DataFrame) -> DataFrame:
    """slug, json: indented text with a last line end."""
    return issues.select("slug", F.concat(F.to_json(F.struct(*issues.columns), {"pretty": "true"}), F.lit("\n")).alias("json"))


def export_items(issues: DataFrame) -> DataFrame:
    """slug, year, sourcePath of an export catalog; the year comes from the publication, a path, or is ``archive``."""
    year = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?:^|/)((?:19|20)\d{2})(?:/|$)", 1), F.lit(""))
    source = F.coalesce("sourceWord", "sourcePdf")
    return issues.select("slug", F.coalesce(F.col("sitePublication.year").cast("string"), year(F.col("jsonPath")), year(source), F.lit("archive")).alias("year"), source.alias("sourcePath")).orderBy("slug")
