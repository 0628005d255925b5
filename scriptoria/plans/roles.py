"""The tables of a catalog, played by the driver's tables: orders are containers, their lines are inner documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("slug"), F.year(day).alias("siteYear"), F.month(day).alias("siteMonth"), F.date_format(day, "yyyy-MM-dd").alias("siteSortDate"), F.lit(None).cast("string").alias("siteLabel"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions come from a total order, as line numbers repeat."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("slug"), F.row_number().over(w).alias("position"), F.col("l_returnflag").alias("documentType"), F.col("l_linestatus").alias("status"),
        F.col("l_suppkey").alias("authorSlug"), F.col("l_quantity").cast("int").alias("paragraphsCount"), F.year("l_shipdate").alias("creationYear"))


CONTAINERS = "c AS (SELECT o_orderkey AS slug, year(o_orderdate)::INT AS siteYear, month(o_orderdate)::INT AS siteMonth, strftime(o_orderdate, '%Y-%m-%d') AS siteSortDate FROM orders)"
DOCUMENTS = (
    "d AS (SELECT l_orderkey AS slug, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice)::INT AS position, "
    "l_returnflag AS documentType, l_linestatus AS status, l_suppkey AS authorSlug, l_quantity::INT AS paragraphsCount, year(l_shipdate)::INT AS creationYear FROM lineitem)"
)
