"""Extension: event-time windows, sessions and state by key as streams whose outcome equals a batch's.

The watermark of a batch is the latest time of earlier batches less the delay.  A row is late, and left out, when its window or session (alone) ends before the watermark of the batch before its own.
Windows and sessions are written once, when the watermark passes their end; those still open at the end of the input are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scriptoria.operators import merged


def windowed_counts(events: DataFrame, time: str, size: str, delay: str, by: str) -> DataFrame:
    """Counts by tumbling window and key."""
    counts = events.withWatermark(time, delay).groupBy(F.window(time, size), by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), by, "n")


def session_counts(events: DataFrame, time: str, gap: str, delay: str, by: str) -> DataFrame:
    """Sessions of each key: stretches of events less than ``gap`` apart, ending ``gap`` after the last one."""
    counts = events.withWatermark(time, delay).groupBy(F.session_window(time, gap), by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def write_closed(windows: DataFrame, path: str, checkpoint: str) -> None:
    """Append every closed window to a table, each once; process what has arrived, then stop."""
    windows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def key_states(events: DataFrame, key: str, time: str, number: str, kind: str) -> DataFrame:
    """For each key its events so far, changes of kind from one event to the next, last kind and time: kept as state between batches.

    Events of a batch are taken in order of (time, number); an event that comes in a later batch counts when it comes."""
    types = dict(events.dtypes)
    state = f"n long, changes long, kind {types[kind]}"

    def step(own: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        n, changes, last = held.get if held.exists else (0, 0, None)
        rows = pd.concat(frames).sort_values([time, number])
        for k in rows[kind]:
            changes += int(n > 0 and k != last)
            n, last = n + 1, k
        held.update((n, changes, last))
        yield pd.DataFrame({key: [own[0]], "n": [n], "changes": [changes], kind: [last]})

    return events.select(key, time, number, kind).groupBy(key).applyInPandasWithState(step, f"{key} {types[key]}, n long, changes long, {kind} {types[kind]}", state, "update", GroupStateTimeout.NoTimeout)


def write_states(states: DataFrame, path: str, checkpoint: str, key: str) -> None:
    """Merge every new state into a table by key, the one with most events last."""

    def one(batch: DataFrame, number: int) -> None:
        merged.merge(batch, path, [key], ["n"], number)

    states.writeStream.foreachBatch(one).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
