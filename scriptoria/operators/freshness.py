"""What has changed between two listings of an archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def listing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """state, oldPath, newPath of every file of two listings (relativePath, sha256, mtime).

    One full outer join by path: ``same`` (digest and time), ``touched`` (another time only), ``changed`` (another digest), ``added``, ``gone``.  Files that
    are gone and added with one digest have ``moved``, paired in order of their paths (as many as there are on both sides).  A null digest or time equals no other but
    null; a file without a digest never moves."""
    side = lambda df, k: df.select(F.col("relativePath").alias("_p"), F.col("relativePath").alias(f"{k}Path"), F.col("sha256").alias(f"_{k}Digest"), F.col("mtime").alias(f"_{k}Time"))
    both = side(before, "old").join(side(after, "new"), "_p", "full_outer")
    digest, time = F.col("_oldDigest").eqNullSafe(F.col("_newDigest")), F.col("_oldTime").eqNullSafe(F.col("_newTime"))
    state = F.when(F.col("oldPath").isNull(), "added").when(F.col("newPath").isNull(), "gone").when(~digest, "changed").when(~time, "touched").otherwise("same")
    both = both.withColumn("state", state)
    ordered = lambda path: F.row_number().over(Window.partitionBy("_d").orderBy(path))
    gone = both.where("state = 'gone'").select(F.coalesce("_oldDigest", F.concat(F.lit("gone "), "oldPath")).alias("_d"), "oldPath")
    added = both.where("state = 'added'").select(F.coalesce("_newDigest", F.concat(F.lit("added "), "newPath")).alias("_d"), "newPath")
    paired = gone.withColumn("_k", ordered("oldPath")).join(added.withColumn("_k", ordered("newPath")), ["_d", "_k"], "full_outer")
    moved = F.when(F.col("oldPath").isNull(), "added").when(F.col("newPath").isNull(), "gone").otherwise("moved")
    return both.where("state not in ('added', 'gone')").select("state", "oldPath", "newPath").union(paired.select(moved, "oldPath", "newPath"))


def to_process(changes: DataFrame) -> DataFrame:
    """Paths (newPath) that a run must read again."""
    return changes.where("state in ('added', 'changed', 'moved')").select("newPath")
