"""A table that is merged by change: rows lie in buckets of their key, and a merge writes the buckets it touches, no others.

``change=N/bucket=B`` holds bucket B as change N left it; ``manifests/N`` says which change each bucket is to be read from.  A manifest appears by a
rename when all its files are there, so readers see one state or the next; a change that is replayed finds its manifest and does
nothing.  Folders that none of the last manifests names are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptoria.operators.load import changed_only
from scriptoria.scratch import materialise


def newest(rows: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """One row a key: the one with the highest version."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in version])
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _file(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the changes that a reader may choose."""
    return [int(n) for n in _names(spark, f"{path}/manifests") if n.isdigit()]


def manifest(spark: SparkSession, path: str, number: int) -> dict:
    """{"buckets": all, "schema": ..., "from": {bucket: change}} of a change."""
    return json.loads(spark.read.text(f"{path}/manifests/{number:012d}", wholetext=True).first()[0])


def _publish(spark: SparkSession, path: str, number: int, content: dict) -> None:
    target, fs = _file(spark, f"{path}/manifests/{number:012d}")
    part, _ = _file(spark, f"{path}/manifests/.{number:012d}.part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(content), "utf-8"))
    out.close()
    if not fs.rename(part, target):
        raise OSError(f"change {number} was published by another writer")


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The table after a change (the last one by default), None before the first."""
    known = [n for n in manifests(spark, path) if number is None or n <= number]
    if not known:
        return None
    now = manifest(spark, path, max(known))
    schema = T.StructType.fromJson(now["schema"])
    folders = [f"{path}/change={change:012d}/bucket={b}" for b, change in now["from"].items()]
    if not folders:
        return spark.createDataFrame([], schema)
    # the folders' own names are no columns of the table
    return spark.read.schema(schema).parquet(*folders)


def merge(rows: DataFrame, path: str, key: list[str], version: list[str] | None = None, number: int | None = None, buckets: int = 16, keep: int = 3) -> list[int]:
    """Merge ``rows`` into the table; returns the buckets that were rewritten.

    With ``version`` the highest version of a key stays; without, a row replaces its predecessor if it differs.  ``number`` names the change (a stream's batch): one
    that is there already changes nothing.  The number of buckets is that of the first change."""
    spark = rows.sparkSession
    known = manifests(spark, path)
    number = (max(known) + 1 if known else 0) if number is None else number
    if number in known:
        return []
    before = [n for n in known if n < number]
    last = manifest(spark, path, max(before)) if before else {"buckets": buckets, "schema": json.loads(rows.schema.json()), "from": {}}
    bucket = F.pmod(F.xxhash64(*key), F.lit(last["buckets"])).cast("int")
    batch = newest(rows, key, version) if version else rows
    old = read(spark, path, max(before)) if before else None
    if old is None:
        changed = batch
    elif version:
        was = old.select(*key, F.struct(*version).alias("_old"))
        changed = batch.join(was, key, "left").where(F.col("_old").isNull() | (F.struct(*version) > F.col("_old"))).drop("_old")
    else:
        changed = changed_only(old, batch, key)
    changed = materialise(changed.select(*rows.columns, bucket.alias("bucket")), "changed")
    touched = sorted(r[0] for r in changed.select("bucket").distinct().collect())  # at most the number of buckets
    if touched:
        out = changed
        same = [f"{path}/change={last['from'][str(b)]:012d}/bucket={b}" for b in touched if str(b) in last["from"]]
        if same:
            rest = spark.read.schema(T.StructType.fromJson(last["schema"])).parquet(*same)
            out = rest.join(changed.select(*key), key, "left_anti").select(*rows.columns, bucket.alias("bucket")).unionByName(changed)
        out.repartition(len(touched), "bucket").sortWithinPartitions("bucket", *key).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/change={number:012d}")
    _publish(spark, path, number, last | {"from": last["from"] | {str(b): number for b in touched}})
    _clean(spark, path, keep)
    return touched


def _clean(spark: SparkSession, path: str, keep: int) -> None:
    """Delete old manifests, and the folders that no manifest names."""
    known = manifests(spark, path)
    for n in known[:-keep]:
        p, fs = _file(spark, f"{path}/manifests/{n:012d}")
        fs.delete(p, False)
    named = {(change, int(b)) for n in known[-keep:] for b, change in manifest(spark, path, n)["from"].items()}
    for folder in _names(spark, path):
        if folder.startswith("change="):
            change = int(folder.split("=")[1])
            for b in _names(spark, f"{path}/{folder}"):
                if b.startswith("bucket=") and change <= known[-1] and (change, int(b.split("=")[1])) not in named:
                    p, fs = _file(spark, f"{path}/{folder}/{b}")
                    fs.delete(p, True)
