"""Shared helpers: scratch tables in the cluster's shared folder, fixed-size filters, table readers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}

#: Words of 64 bits in a fixed-size filter (2**18 longs, 2 MB): its size never follows the data.
FILTER_WORDS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master may go without that setting (tests, one machine): it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="scriptoria-shared-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], True)
    return _OWN_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/scriptoria/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch: whole texts are long, and the usual 10,000 of them would fill an executor's memory.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``ARROW_ROWS`` unless the session has a value of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


#: With this, the exchanges of a write are deleted on all executors when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: this cuts the lineage,
    survives lost executors and lets several consumers share one computation.  Nothing reads the exchanges
    behind the table again, so they are freed with the write."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Ids up to this number (about 8 MB) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 500_000


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not in the one column of ``gone``; rows without an id stay."""
    name = fresh_name(docs, "gone")
    ids = gone.toDF(name)
    ids = materialise(ids.where(F.col(name).isNotNull()).distinct(), "gone")
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = F.broadcast(ids) if small else ids
    return docs.join(ids, F.col(id_col).cast("long") == F.col(name), "left_anti")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"__{base}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan (for a file scan: the size of its files)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def data_width(df: DataFrame, per_task: int = 256 << 20) -> int:
    """Tasks of an exchange whose volume follows that of ``df``: the session's width, or more for a large input."""
    return max(shuffle_width(df.sparkSession), -(-estimated_bytes(df) // per_task))


def mixed(key: Column) -> Column:
    """A well-mixed non-negative long of any key."""
    return F.xxhash64(key).bitwiseAND(F.lit((1 << 62) - 1))


def key_filter_words(keys: DataFrame, key: str, by_value: bool = False) -> np.ndarray:
    """One-bit-per-key filter of ``FILTER_WORDS`` longs over the column ``key``.

    Computed natively: bits are OR-ed per word before the shuffle, and at most ``FILTER_WORDS`` rows reach
    the driver whatever the number of keys.  A full filter lets every row pass, so it only saves work.  Keys that are
    well mixed already are taken by value.
    """
    h = F.col(key).bitwiseAND(F.lit((1 << 62) - 1)) if by_value else mixed(F.col(key))
    rows = (
        keys.select((h % FILTER_WORDS).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftright(h, 40) % 64).cast("int")).alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b"))
    )
    found = rows.toArrow()
    words = np.zeros(FILTER_WORDS, np.int64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return words
