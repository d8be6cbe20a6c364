"""Runs, releases and archives: states told by append-only events, reuse of earlier results by
what they are bound to, and files held against their manifests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest error message that is kept.
MESSAGE = 500


def run_states(events: DataFrame, run: str, seq: str, attempt_kinds: tuple[str, ...] = ("bootstrap", "page", "resolve", "pdf", "session")) -> DataFrame:
    """(run, status, started_at, finished_at, bytes, error, one count of attempts per kind) of
    append-only ``events``: run, seq, kind (start, attempt:<kind>, finish), at, status, bytes, error.

    The last finish wins; a run without one is ``running``, one without a start too. Messages are
    cut at MESSAGE characters. One partial aggregate; no run's events are brought together.
    """
    finish = F.col("kind") == "finish"
    last = lambda c: F.max_by(F.when(finish, F.col(c)), F.when(finish, F.col(seq)))
    attempts = [F.count_if(F.col("kind") == f"attempt:{k}").alias(f"{k}_attempts") for k in attempt_kinds]
    grouped = events.groupBy(run).agg(
        F.min(F.when(F.col("kind") == "start", F.col("at"))).alias("started_at"), last("at").alias("finished_at"), last("status").alias("status"),
        last("bytes").alias("bytes"), F.substring(last("error"), 1, MESSAGE).alias("error"), *attempts,
    )
    return grouped.withColumn("status", F.coalesce("status", F.lit("running")))


def recovered(items: DataFrame, status: str = "status") -> DataFrame:
    """``items`` with those cut off while ``running`` set back to ``pending``."""
    return items.withColumn(status, F.when(F.col(status) == "running", "pending").otherwise(F.col(status)))


def to_resume(items: DataFrame, status: str, failed: tuple[str, ...], secret: tuple[str, ...], refresh: bool = False) -> DataFrame:
    """The items a resumed batch goes on with: no failed ones, and secret ones only to refresh them.
    Items of null status are new and go on."""
    skip = [*failed, *([] if refresh else secret)]
    return items.where(F.col(status).isNull() | ~F.col(status).isin(skip))


def reusable(wanted: DataFrame, stored: DataFrame, binding: list[str], intact: Column | None = None) -> DataFrame:
    """``wanted`` with ``reuse``: whether something stored has the same source, configuration and
    whatever else ``binding`` names, and is ``intact``. Null bindings are never reused."""
    ok = stored if intact is None else stored.where(F.coalesce(intact, F.lit(False)))
    keys = ok.select(*binding).distinct().withColumn("_found", F.lit(True))
    return wanted.join(keys, binding, "left").withColumn("reuse", F.coalesce("_found", F.lit(False))).drop("_found")


def whole_documents(pages: DataFrame, documents: DataFrame, binding: list[str], page: str, count: str) -> DataFrame:
    """``documents`` whose cached pages are exactly 1 to ``count``: a cache with a page missing,
    twice under another number or beyond the end is not adopted. Repeated rows count once."""
    n = pages.where(F.col(page).isNotNull()).groupBy(*binding).agg(F.countDistinct(page).alias("_n"), F.min(page).alias("_low"), F.max(page).alias("_high"))
    whole = (F.col("_n") == F.col(count)) & (F.col("_low") == 1) & (F.col("_high") == F.col(count))
    return documents.join(n, binding).where(whole).drop("_n", "_low", "_high")


def admitted(sources: DataFrame, allowed: DataFrame, held_out: DataFrame, key: str, sha: str, frozen: bool) -> DataFrame:
    """``sources`` with ``authorization``: ``development`` and ``holdout`` for those in these
    lists under the same hash (held out ones only once the configuration is ``frozen``), ``changed``
    for those listed under another hash, ``frozen_first`` for held-out ones before, else ``unknown``."""
    lists = allowed.select(key, F.col(sha).alias("_sha"), F.lit("development").alias("_role")).unionByName(held_out.select(key, F.col(sha).alias("_sha"), F.lit("holdout").alias("_role")))
    one = lists.groupBy(key).agg(F.max_by("_sha", "_role").alias("_sha"), F.max("_role").alias("_role"))
    told = (
        F.when(F.col("_role").isNull(), "unknown").when(~F.col("_sha").eqNullSafe(F.col(sha)), "changed")
        .when((F.col("_role") == "holdout") & F.lit(not frozen), "frozen_first").otherwise(F.col("_role"))
    )
    return sources.join(one, key, "left").withColumn("authorization", told).drop("_sha", "_role")


def verified(manifest: DataFrame, found: DataFrame, path: str = "path", sha: str = "sha256", size: str = "size_bytes") -> DataFrame:
    """(path, state): ``same``, ``changed``, ``missing`` or ``extra`` of the files of a manifest and
    those found. Repeated paths of equal content count once."""
    a = manifest.select(path, F.struct(sha, size).alias("_was")).distinct()
    b = found.select(path, F.struct(sha, size).alias("_is")).distinct()
    both = a.join(b, path, "full_outer")
    state = F.when(F.col("_was").isNull(), "extra").when(F.col("_is").isNull(), "missing").when(F.col("_was").eqNullSafe(F.col("_is")), "same").otherwise("changed")
    return both.select(path, state.alias("state"))


def purgeable(releases: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """``releases`` (key, status, mode, source_retained) with ``purge``: whether the source may be
    deleted: completed in mode ``both``, still there, with an output, and every output (key,
    intact) intact. The deletion itself is not the engine's."""
    checked = outputs.groupBy(key).agg(F.count("*").alias("_n"), F.min(F.coalesce("intact", F.lit(False))).alias("_intact"))
    may = (F.col("status") == "completed") & (F.col("mode") == "both") & F.col("source_retained") & (F.col("_n") > 0) & F.col("_intact")
    return releases.join(checked, key, "left").withColumn("purge", F.coalesce(may, F.lit(False))).drop("_n", "_intact")


def url_conflicts(updates: DataFrame, sources: DataFrame, case: str, url: str) -> DataFrame:
    """(url, case, owner): URLs of ``updates`` that ``sources`` give to another case, or two cases
    of the updates claim (the least is the owner)."""
    first = updates.where(F.col(url).isNotNull()).groupBy(url).agg(F.min(case).alias("_claim"))
    owned = sources.where(F.col(url).isNotNull()).groupBy(url).agg(F.min(case).alias("_own"))
    owner = F.coalesce("_own", "_claim")
    both = updates.join(first, url).join(owned, url, "left").withColumn("owner", owner)
    return both.where(F.col(case) != F.col("owner")).select(url, case, "owner").distinct()


def summary_report(title: str, sections: dict[str, DataFrame], limit: int = 1000) -> str:
    """Markdown of small result tables (totals, ratios, counts): at most ``limit`` rows each; a
    longer table is refused, as a report is for reading."""
    out = [f"# {title}"]
    for name, df in sections.items():
        rows = df.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{name}: more than {limit} rows")
        text = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "| " + " | ".join("---" for _ in df.columns) + " |"]
        out += ["| " + " | ".join(map(text, r)) + " |" for r in rows]
    return "\n".join(out) + "\n"


def export_batch(results: DataFrame, folder: str, order: str, summary: DataFrame) -> None:
    """results (JSON lines in order), summary and manifest of a batch in ``folder``; an existing
    manifest is kept, as it is written once."""
    results.orderBy(order).write.mode("overwrite").json(f"{folder}/results")
    summary.write.mode("overwrite").json(f"{folder}/summary")
    described = results.sparkSession.createDataFrame([(order, c, t) for c, t in results.dtypes], "ordered_by string, field string, type string")
    described.write.mode("ignore").json(f"{folder}/manifest")


def frozen_configuration(options: dict[str, object]) -> tuple[str, Callable[[dict[str, object]], bool]]:
    """The hash of a configuration (members in order of name) and a test whether another one is the same."""
    import hashlib
    import json

    digest = lambda o: hashlib.sha256(json.dumps(o, sort_keys=True, default=str).encode()).hexdigest()
    own = digest(options)
    return own, lambda other: digest(other) == own
