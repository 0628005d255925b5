"""A catalog stored for nesting: containers and inner documents in buckets by slug within years.

Both tables have the same number of buckets, so all rows of a slug lie in the same bucket of either one.  Nesting documents below
their containers is then a grouping and a join inside a bucket: no row crosses the network.  A year is a folder of both tables, so a
listing of one year opens that year alone, and a look-up of one slug opens one bucket of it.

A bucket of one year is one file.  ``buckets`` is the number of tasks of a listing: choose it so that a bucket of all years fits a
task (about 200 MB of Parquet), and no more, as the number of files is buckets x years.

Documents without a container and rows with a null slug have no year: they are kept, in the folder of the null year, and never nested.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scriptoria.operators import catalog as C

#: Buckets of a table without a stated number.
BUCKETS = 64


@dataclass(frozen=True)
class Store:
    """Both tables below ``path``."""

    containers: DataFrame
    documents: DataFrame

    def catalog(self, filters: C.Filters, matched: DataFrame | None = None) -> DataFrame:
        """The online listing (``catalog.catalog``) without an exchange below the nesting; a search's ``matched`` keys are the one thing moved."""
        return C.catalog(self._chosen(filters), self._children(filters), _no_year(filters), matched)

    def offline_catalog(self, filters: C.Filters) -> DataFrame:
        """The offline listing (``catalog.offline_catalog``), likewise."""
        return C.offline_catalog(self._chosen(filters), self._children(filters), _no_year(filters))

    def detail(self, site_year: int, slug) -> DataFrame:
        """One container with its documents, from one bucket of one year."""
        return C.detail(self.containers, self._children(C.Filters(siteYear=site_year)), site_year, slug)

    def _chosen(self, filters: C.Filters) -> DataFrame:
        return C.where(self.containers, filters.container_predicate())

    def _children(self, filters: C.Filters) -> DataFrame:
        return C.where(self.documents, filters.container_predicate()).drop("siteYear")


def _no_year(filters: C.Filters) -> C.Filters:
    """The year is a folder already, so no semi-join has to carry it to the documents."""
    return C.Filters(None, filters.authorSlug, filters.documentType, filters.q, filters.creationYear)


def _table(path: str, name: str) -> str:
    return f"scriptoria_{name}_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def write(containers: DataFrame, documents: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write both tables below ``path``, which must be new; the folder ``layout`` comes last and marks them complete.

    Documents take their container's ``siteYear`` by one join on the slug; their own column of that name, if any, is replaced.  One
    shuffle by slug then makes one file of each bucket and year.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    years = containers.select("slug", "siteYear")
    documents = documents.drop("siteYear").join(years, "slug", "left")
    spark, layout = containers.sparkSession, []
    for name, rows, order in (("containers", containers, ["slug"]), ("documents", documents, ["slug", "position"])):
        rows = rows.select(*[c for c in rows.columns if c != "siteYear"], "siteYear")
        table = _table(path, name)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        rows.repartition(buckets, "slug").write.partitionBy("siteYear").bucketBy(buckets, "slug").sortBy(*order).option("path", f"{path}/{name}").saveAsTable(table)
        layout.append((name, buckets, order, rows.schema.toDDL()))
    spark.createDataFrame(layout, "name string, buckets int, sorted array<string>, columns string").coalesce(1).write.json(f"{path}/layout")


def open_store(spark: SparkSession, path: str) -> Store:
    """The tables that ``write`` made, in any session: their layout is read from the folder, not from a catalog that must have lasted."""
    tables = {}
    for r in spark.read.schema("name string, buckets int, sorted array<string>, columns string").json(f"{path}/layout").collect():
        table = _table(path, r["name"])
        if not spark.catalog.tableExists(table):
            spark.sql(
                f"CREATE TABLE {table} ({r['columns']}) USING parquet PARTITIONED BY (siteYear) CLUSTERED BY (slug) SORTED BY ({', '.join(r['sorted'])}) INTO {r['buckets']} BUCKETS LOCATION '{path}/{r['name']}'"
            )
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        tables[r["name"]] = spark.table(table)
    return Store(tables["containers"], tables["documents"])
