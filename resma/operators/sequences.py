"""Ordered rows: islands, chunks, ranges, streaks, spacing, and instruments from page roles.

All are windows partitioned by an entity (a document, a user); none orders a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, entity: list[str], position: str) -> DataFrame:
    """Runs of consecutive positions: entity, start, stop, size. Repeated positions count once;
    null positions are left out."""
    one = df.where(F.col(position).isNotNull()).select(*entity, position).distinct()
    run = F.col(position) - F.row_number().over(Window.partitionBy(*entity).orderBy(position))
    return one.withColumn("_run", run).groupBy(*entity, "_run").agg(F.min(position).alias("start"), F.max(position).alias("stop"), F.count("*").alias("size")).drop("_run")


def chunks(df: DataFrame, entity: list[str], position: str, most: int) -> DataFrame:
    """Runs of consecutive positions cut into chunks of at most ``most``: entity, start, stop, size."""
    one = df.where(F.col(position).isNotNull()).select(*entity, position).distinct()
    run = F.col(position) - F.row_number().over(Window.partitionBy(*entity).orderBy(position))
    nth = F.row_number().over(Window.partitionBy(*entity, "_run").orderBy(position))
    parts = one.withColumn("_run", run).withColumn("_part", F.floor((nth - 1) / most))
    return parts.groupBy(*entity, "_run", "_part").agg(F.min(position).alias("start"), F.max(position).alias("stop"), F.count("*").alias("size")).drop("_run", "_part")


def ranges_from_starts(starts: DataFrame, entity: list[str], start: str, last: str) -> DataFrame:
    """Ranges that begin at ``start`` and end before the next start or at ``last``."""
    after = F.lead(start).over(Window.partitionBy(*entity).orderBy(start))
    return starts.withColumn("stop", F.coalesce(after - 1, F.col(last)))


def cover_whole(ranges: DataFrame, entity: list[str], start: str, stop: str, last: str) -> DataFrame:
    """entity, covers: whether the ranges follow one another from 1 to ``last`` without gap or overlap."""
    before = F.lag(stop, 1, 0).over(Window.partitionBy(*entity).orderBy(start))
    each = ranges.withColumn("_ok", (F.col(start) == before + 1) & (F.col(stop) >= F.col(start)))
    return each.groupBy(*entity).agg((F.min("_ok") & (F.max(stop) == F.max(last))).alias("covers"))


def neighbours(df: DataFrame, entity: list[str], position: str, low: str, high: str, reach: int = 1) -> DataFrame:
    """Positions within ``reach`` of the given ones, kept within low and high; each once."""
    near = F.sequence(F.greatest(F.col(low), F.col(position) - reach), F.least(F.col(high), F.col(position) + reach))
    return df.where(F.col(position).between(F.col(low), F.col(high))).select(*entity, F.explode(near).alias(position)).distinct()


def streaks(df: DataFrame, entity: list[str], order: list[str], failed: Column) -> DataFrame:
    """``df`` with ``streak``: failures in a row up to and with the row, 0 at a success."""
    w = Window.partitionBy(*entity).orderBy(*order)
    fail = F.coalesce(failed, F.lit(False))
    group = F.sum(F.when(fail, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = df.withColumn("_fail", fail.cast("int")).withColumn("_since", group)
    run = Window.partitionBy(*entity, "_since").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("streak", F.sum("_fail").over(run)).drop("_fail", "_since")


def spacing(df: DataFrame, entity: list[str], time: str, order: list[str], interval: float) -> DataFrame:
    """``df`` with ``wait``: seconds each row would have to wait for ``interval`` since the one before."""
    gap = F.unix_micros(F.col(time)) - F.unix_micros(F.lag(time).over(Window.partitionBy(*entity).orderBy(*order)))
    return df.withColumn("wait", F.greatest(F.lit(0.0), F.lit(interval) - F.coalesce(gap, F.lit(int(interval * 1e6))) / 1e6))


def instruments(pages: DataFrame, entity: list[str], position: str, role: str, starts: str | None = None) -> DataFrame:
    """Multi-page instruments from page roles: A begins, B is whole, C goes on, E ends, F is a
    fragment, N none, U unclear.

    entity, start, stop, size, outcome: ``instrument`` (begun and ended), ``incomplete`` (begun
    and not ended), ``orphan`` (C or E without a beginning), ``unclear`` (U), ``fragment`` (F).
    A gap in the positions, another beginning, any other role and, where the column ``starts``
    is true, a new attachment end what is open. Repeated positions must not occur.
    """
    w = Window.partitionBy(*entity).orderBy(position)
    r = F.col(role)
    after_gap = F.coalesce(F.col(position) != F.lag(position).over(w) + 1, F.lit(True))
    cut = after_gap | (F.coalesce(F.col(starts), F.lit(False)) if starts else F.lit(False))
    before = F.lag(role).over(w)
    goes_on = r.isin("C", "E") & ~cut & before.isin("A", "C")
    parts = pages.withColumn("_goes_on", goes_on)
    # a C that follows an orphan C is an orphan of its own: a run is open only from an A on
    run = F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.withColumn("_run", run)
    head = F.first(role).over(Window.partitionBy(*entity, "_run").orderBy(position))
    parts = parts.withColumn("_head", head).withColumn("_single", F.when(F.col("_head") == "A", F.lit(-1)).otherwise(F.col(position)))
    grouped = parts.groupBy(*entity, "_run", "_single").agg(F.min(position).alias("start"), F.max(position).alias("stop"), F.count("*").alias("size"), F.max_by(role, position).alias("_last"), F.min_by(role, position).alias("_first"))
    outcome = (
        F.when((F.col("_first") == "B") | ((F.col("_first") == "A") & (F.col("_last") == "E")), "instrument")
        .when(F.col("_first") == "A", "incomplete").when(F.col("_first").isin("C", "E"), "orphan").when(F.col("_first") == "U", "unclear").when(F.col("_first") == "F", "fragment")
    )
    return grouped.withColumn("outcome", outcome).where(F.col("outcome").isNotNull()).select(*entity, "start", "stop", "size", "outcome")
