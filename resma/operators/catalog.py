"""The catalog of cases, documents and runs as joins and windows over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1).drop("_nth")


def absent(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose keys do not exist yet, each key once (the first by all columns).
    A null key never exists."""
    fresh = new.join(existing.select(*keys).distinct(), keys, "left_anti")
    return latest(fresh, keys, [F.col(c).asc_nulls_last() for c in fresh.columns])


def upserted(existing: DataFrame, updates: DataFrame, keys: list[str], keep_old_if_null: list[str]) -> DataFrame:
    """``existing`` with the rows of ``updates`` (one per key) put over them: all fields of an
    update replace the old ones, but those of ``keep_old_if_null`` only where they are not null."""
    fields = [c for c in existing.columns if c not in keys]
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in fields if c in updates.columns], F.lit(True).alias("_updated"))
    both = existing.withColumn("_existed", F.lit(True)).join(new, keys, "full_outer")
    out = []
    for c in fields:
        if c not in updates.columns:
            out.append(F.col(c))
        elif c in keep_old_if_null:
            out.append(F.coalesce(f"_new_{c}", c).alias(c))
        else:
            out.append(F.when(F.col("_updated"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    state = F.when(F.col("_existed").isNull(), "inserted").when(F.col("_updated"), "updated").otherwise("kept")
    return both.select(*keys, *out, state.alias("upsert"))


def replaced_if(existing: DataFrame, new: DataFrame, keys: list[str], replaceable: Column) -> tuple[DataFrame, DataFrame]:
    """(table, conflicts): rows of ``new`` are inserted, or replace an existing row for which
    ``replaceable`` holds; new rows that meet another existing row are conflicts."""
    flagged = existing.withColumn("_free", F.coalesce(replaceable, F.lit(False)))
    held = flagged.where(~F.col("_free")).select(*keys)
    conflicts = new.join(held, keys, "left_semi")
    accepted = new.join(held, keys, "left_anti")
    kept = existing.join(accepted.select(*keys), keys, "left_anti")
    return kept.unionByName(accepted), conflicts


def status_counts(df: DataFrame, status: str) -> DataFrame:
    """Rows by status and their total (status ``total``)."""
    rolled = df.groupBy(status).agg(F.count("*").alias("n"))
    return rolled.select(F.coalesce(status, F.lit("null")).alias("status"), "n").unionByName(rolled.agg(F.lit("total").alias("status"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def export_lines(df: DataFrame, order: str) -> DataFrame:
    """Rows as JSON texts without null fields: (order, line)."""
    return df.select(F.col(order), F.to_json(F.struct(*df.columns)).alias("line"))


def write_event_log(events: DataFrame, path: str, time: str, keep_days: int | None = None) -> None:
    """Appends events as JSON lines in one folder per day; null fields are dropped. With
    ``keep_days`` events older than that before the newest are left out."""
    dated = events.withColumn("day", F.to_date(time))
    if keep_days is not None:
        newest = dated.agg(F.max("day").alias("_newest"))
        dated = dated.crossJoin(F.broadcast(newest)).where(F.col("day") > F.date_sub("_newest", keep_days)).drop("_newest")  # one row
    dated.write.mode("append").partitionBy("day").json(path)
