"""Resumable batches and state that outlives a run, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def run_batches(items: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands what is new in the stream ``items`` to ``handle`` (rows, batch number) and ends.
    Batches that were committed are not handed over again after a restart; one that was cut off
    is handed over again under its number, by which ``handle`` can replace its output."""
    return items.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def failure_streaks(events: DataFrame, entity: str, failed: str, limit: int) -> DataFrame:
    """(entity, streak, paused) after each batch: failures in a row since the last success, and
    whether they reached ``limit``; the state outlives restarts. ``failed`` is a boolean column;
    rows of one batch are taken in the order of the column ``seq``."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        for frame in frames:
            for bad in frame.sort_values("seq")[failed]:
                streak = streak + 1 if bad else 0
        state.update((streak,))
        yield pd.DataFrame({entity: [key[0]], "streak": [streak], "paused": [streak >= limit]})

    kind = events.schema[entity].dataType.simpleString()
    return events.groupBy(entity).applyInPandasWithState(step, f"`{entity}` {kind}, streak long, paused boolean", "streak long", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, time: str, kind: str, width: str, late: str) -> DataFrame:
    """(start, kind, n) by tumbling windows of ``width``; rows later than ``late`` are dropped.
    Works on streams and tables (an extension: the watermark has no effect on tables)."""
    from pyspark.sql import functions as F

    source = events.withWatermark(time, late) if events.isStreaming else events
    return source.groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
