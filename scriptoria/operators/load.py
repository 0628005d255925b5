"""Load of parsed issues into the two catalog tables, with assertions on their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.functions.publication import load_publication
from scriptoria.functions.text import description
from scriptoria.operators import postings, search


def containers(issues: DataFrame, default_year: int) -> DataFrame:
    """Container rows of parsed issues."""
    source = F.coalesce("sourceWord", "sourcePdf")
    rows = issues.withColumn("_p", load_publication(F.col("sitePublication"), source, F.col("jsonPath"), default_year))
    year = F.coalesce("_p.year", F.lit(default_year))
    return rows.select(
        "slug", "title", F.col("_p.label").alias("siteLabel"), F.col("_p.rawLabel").alias("siteRawLabel"), year.alias("siteYear"), F.col("_p.month").alias("siteMonth"), F.col("_p.months").alias("siteMonths"),
        F.coalesce("_p.sortDate", F.concat(year.cast("string"), F.lit("-01-01"))).alias("siteSortDate"), "documentsCount", "sourcePdf", "sourceWord", "preparedDocx", "jsonPath",
        F.col("meta.pages").alias("pages"), F.col("meta.layout").alias("layout"), F.to_timestamp("parsedAt").alias("parsedAt"),
    )


def documents(issues: DataFrame) -> DataFrame:
    """Inner document rows of parsed issues; a wrong date is an error."""
    rows = issues.select("slug", F.posexplode("documents").alias("_i", "d"))
    body, header = F.transform("d.parts.body", lambda p: p["text"]), F.col("d.parts.header")
    line = F.col("d.pearlPublication")
    return rows.select(
        F.concat_ws("-", "slug", (F.col("_i") + 1).cast("string")).alias("id"), F.col("slug"), (F.col("_i") + 1).alias("position"), F.col("d.documentTitle").alias("documentTitle"),
        F.col("d.documentType").alias("documentType"), description(body, header).alias("description"), F.col("d.author.name").alias("authorName"), F.col("d.author.slug").alias("authorSlug"),
        F.col("d.author.raw").alias("authorRaw"), F.to_date(F.nullif("d.creation.date", F.lit(""))).alias("creationDate"), F.col("d.creation.year").alias("creationYear"), F.col("d.creation.raw").alias("creationRaw"),
        line["volume"].alias("pearlVolume"), line["issue"].alias("pearlIssue"), F.to_date(F.nullif(line["date"], F.lit(""))).alias("pearlDate"), line["rawDate"].alias("pearlRawDate"), line["raw"].alias("pearlRaw"),
        header.alias("header"), F.transform("d.parts.footer", lambda p: p["text"]).alias("footer"), F.array_join(body, "\n\n").alias("content"), F.size(body).alias("paragraphsCount"),
    )


def problems(cont: DataFrame, docs: DataFrame) -> DataFrame:
    """check, n: violations of keys and counts (all zero for sound tables)."""
    repeated = lambda df, *k: df.groupBy(*k).count().where("count > 1")
    children = docs.groupBy("slug").agg(F.count(F.lit(1)).alias("_n"))
    wrong = cont.join(children, "slug", "left").where(F.coalesce("_n", F.lit(0)) != F.col("documentsCount"))
    checks = {"repeated slug": repeated(cont, "slug"), "repeated id": repeated(docs, "id"), "repeated position": repeated(docs, "slug", "position"), "orphan": docs.join(cont, "slug", "left_anti"), "count": wrong}
    out = None
    for name, df in checks.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
        out = one if out is None else out.union(one)
    return out


def _file_system(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark, path: str) -> str:
    """Folder of the generation that a load finished last."""
    p, fs = _file_system(spark, f"{path}/generations")
    done = [s.getPath().getName() for s in fs.listStatus(p) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_LOADED"))] if fs.exists(p) else []
    if not done:
        raise LookupError(f"nothing is loaded below {path}")
    return f"{path}/generations/{max(done)}"


def rebuild(issues: DataFrame, path: str, default_year: int, strict: bool = True, keep: int = 2, config: search.Config | None = None) -> None:
    """Write both tables (containers by year) and the search index of the inner documents as a new generation below ``path``; unsound input is an error before anything is written.

    A generation counts once all is there, so readers never see one table without the other and a failure leaves the
    last one in place.  The last ``keep`` generations stay.
    """
    cont, docs = containers(issues, default_year), documents(issues)
    if strict:
        bad = [r for r in problems(cont, docs).collect() if r["n"]]
        if bad:
            raise ValueError("unsound input: " + ", ".join(f"{r['check']} ({r['n']})" for r in bad))
    spark = issues.sparkSession
    root, fs = _file_system(spark, f"{path}/generations")
    names = sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []
    new = f"{path}/generations/{int(names[-1]) + 1 if names else 1:012d}"
    cont.write.partitionBy("siteYear").parquet(f"{new}/containers")
    docs.write.parquet(f"{new}/documents")
    written = spark.read.parquet(f"{new}/documents").join(spark.read.parquet(f"{new}/containers").select("slug", "siteYear"), "slug", "left")
    postings.catalog_index(written, f"{new}/index", config or search.Config.russian(spark), F.col("siteYear"))
    fs.create(_file_system(spark, f"{new}/_LOADED")[0]).close()
    for name in names[: max(0, len(names) + 1 - keep)]:
        fs.delete(_file_system(spark, f"{path}/generations/{name}")[0], True)


def index(spark, path: str, config: search.Config | None = None) -> postings.Index:
    """The search index of the generation that a load finished last; ``config`` as the load had it."""
    return postings.Index(f"{current(spark, path)}/index", postings.CATALOG_KEY, config or search.Config.russian(spark), postings.CATALOG_BUCKETS)


def changed_only(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` that are absent from ``old`` or differ there (nulls compared as values)."""
    fields = [c for c in new.columns if c not in key]
    was = old.select(*key, F.struct(*fields).alias("_old"))
    joined = new.withColumn("_new", F.struct(*fields)).join(was, key, "left")
    return joined.where(~F.col("_new").eqNullSafe(F.col("_old"))).drop("_new", "_old")
