"""Which pages of a document may hold what is sought, and how pages go on: neighbours, printed
counters, attachments, probes, residual search, boundaries worth a second look.

Predicates (titles, headings, bodies) are the caller's columns; the operators are windows of one
page's reach, equi-joins and aggregates by document. ``entity`` are the columns of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_neighbours(pages: DataFrame, entity: list[str], position: str, columns: list[str]) -> DataFrame:
    """``pages`` with ``before_<c>`` and ``after_<c>`` of the pages numbered one less and one more
    (null where there is none): equi-joins by the number, so no document is one task. Positions
    must not repeat."""
    out = pages
    for name, step in (("before", 1), ("after", -1)):
        side = pages.select(*entity, (F.col(position) + step).alias(position), *[F.col(c).alias(f"{name}_{c}") for c in columns])
        out = out.join(side, [*entity, position], "left")
    return out


def continuations(pages: DataFrame, entity: list[str], position: str, counter: str, otherwise: Column | None = None, independent: Column | None = None) -> DataFrame:
    """``pages`` with ``continues``: ``consecutive_counter`` where the page before bears the printed
    counter (a, b) and this one (a + 1, b); else ``content`` where ``otherwise`` holds; null where the
    page is ``independent`` or nothing tells that it goes on."""
    told = in_neighbours(pages, entity, position, [counter])
    c, b = F.col(counter), F.col(f"before_{counter}")
    follows = (c["page"] == b["page"] + 1) & (c["of"] == b["of"])
    kind = F.when(F.coalesce(follows, F.lit(False)), "consecutive_counter")
    if otherwise is not None:
        kind = kind.when(F.coalesce(otherwise, F.lit(False)), "content")
    if independent is not None:
        kind = F.when(~F.coalesce(independent, F.lit(False)), kind)
    return told.withColumn("continues", kind).drop(f"before_{counter}", f"after_{counter}")


def content_ranges(ranges: DataFrame, documents: DataFrame, entity: list[str], start: str, stop: str, last: str, alone: Column | None = None) -> DataFrame:
    """(entity, start, stop, indexed): the ranges of documents that cover every page once; any
    other document is one range from 1 to ``last``, not indexed. A single range for which ``alone``
    holds (one without an index) is kept but not indexed."""
    w = Window.partitionBy(*entity).orderBy(start, stop)
    flagged = ranges.withColumn("_alone", F.coalesce(alone, F.lit(False)) if alone is not None else F.lit(False))
    each = flagged.withColumn("_ok", (F.col(start) == F.coalesce(F.lag(stop).over(w), F.lit(0)) + 1) & (F.col(stop) >= F.col(start)))
    told = each.groupBy(*entity).agg(F.min(F.coalesce("_ok", F.lit(False))).alias("_ok"), F.max(stop).alias("_stop"), F.count("*").alias("_n"), F.max("_alone").alias("_alone"))
    state = documents.select(*entity, last).join(told, entity, "left").withColumn("_whole", F.coalesce(F.col("_ok") & (F.col("_stop") == F.col(last)), F.lit(False)))
    kept = ranges.select(*entity, start, stop).join(state.where("_whole").select(*entity, (~((F.col("_n") == 1) & F.col("_alone"))).alias("indexed")), entity)
    fallback = state.where("NOT _whole").select(*entity, F.lit(1).cast(ranges.schema[start].dataType).alias(start), F.col(last).cast(ranges.schema[stop].dataType).alias(stop), F.lit(False).alias("indexed"))
    return kept.unionByName(fallback)


def planned_groups(ranges: DataFrame, pages: DataFrame, entity: list[str], start: str, stop: str, position: str, hit: Column, score: Column, least: int, probes: int = 2) -> DataFrame:
    """(entity, start, stop, score, hit, selected, place): each range with the score of its title
    and whether one of its first ``probes`` pages is a ``hit``. Indexed ranges of ``least`` or more, or
    with a hit, are selected; place orders them by score and start within their document."""
    scored = ranges.withColumn("score", score)
    probe = scored.select(*entity, start, F.explode(F.sequence(F.col(start), F.least(F.col(stop), F.col(start) + probes - 1))).alias(position))
    hits = pages.where(F.coalesce(hit, F.lit(False))).select(*entity, position).distinct()
    found = probe.join(hits, [*entity, position], "left_semi").select(*entity, start).distinct().withColumn("_hit", F.lit(True))
    told = scored.join(found, [*entity, start], "left").withColumn("hit", F.coalesce("_hit", F.lit(False)))
    chosen = told.withColumn("selected", F.col("indexed") & ((F.col("score") >= least) | F.col("hit")))
    nth = F.row_number().over(Window.partitionBy(*entity, "selected").orderBy(F.desc("score"), start))
    return chosen.withColumn("place", F.when(F.col("selected"), nth)).select(*entity, start, stop, "score", "hit", "selected", "place")


def residual_pages(ranges: DataFrame, pages: DataFrame, entity: list[str], start: str, stop: str, position: str, strong: Column, hint: Column, uncertain: Column, classified: DataFrame) -> DataFrame:
    """(entity, position) of pages still to look at: all of a range in which a page is ``strong`` or
    whose title is a ``hint``, else the pages around ``uncertain`` ones, within their range; never
    pages that are ``classified``. A range all of whose pages are classified has none."""
    marked = pages.select(*entity, position, F.coalesce(strong, F.lit(False)).alias("_strong"), F.coalesce(uncertain, F.lit(False)).alias("_unsure"))
    whole = ranges.select(*entity, start, stop, F.coalesce(hint, F.lit(False)).alias("_hint"))
    each = whole.withColumn(position, F.explode(F.sequence(F.col(start), F.col(stop)))).join(marked, [*entity, position], "left")
    any_strong = each.groupBy(*entity, start, stop).agg((F.max("_hint") | F.coalesce(F.max("_strong"), F.lit(False))).alias("_all"), F.max(F.coalesce("_unsure", F.lit(False))).alias("_some"))
    full = any_strong.where("_all").select(*entity, F.explode(F.sequence(F.col(start), F.col(stop))).alias(position))
    around = each.where("_unsure").join(any_strong.where("NOT _all AND _some").select(*entity, start, stop), [*entity, start, stop], "left_semi")
    near = around.select(*entity, F.explode(F.sequence(F.greatest(F.col(start), F.col(position) - 1), F.least(F.col(stop), F.col(position) + 1))).alias(position))
    return full.unionByName(near).distinct().join(classified.select(*entity, position), [*entity, position], "left_anti")


def boundary_suspects(pages: DataFrame, entity: list[str], position: str, role: str, continues: str, independent: Column | None = None) -> DataFrame:
    """(entity, position, why): pages whose role may end or part something too early: ``early_end`` for
    B or E before a page that goes on (or is C or E) and begins nothing, ``gap`` for N between A or C and C or E."""
    near = in_neighbours(pages, entity, position, [role, continues])
    before, after = F.col(f"before_{role}"), F.col(f"after_{role}")
    early = F.col(role).isin("B", "E") & ~after.isin("A", "B", "F") & (F.col(f"after_{continues}").isNotNull() | after.isin("C", "E"))
    own = ~F.coalesce(independent, F.lit(False)) if independent is not None else F.lit(True)
    gap = (F.col(role) == "N") & own & before.isin("A", "C") & after.isin("C", "E")
    why = F.when(F.coalesce(early, F.lit(False)), "early_end").when(F.coalesce(gap, F.lit(False)), "gap")
    return near.withColumn("why", why).where("why IS NOT NULL").select(*entity, position, "why")


def crossing_candidates(ranges: DataFrame, pages: DataFrame, entity: list[str], start: str, stop: str, position: str, role: str, continues: str) -> DataFrame:
    """(entity, stop, start): borders of neighbouring ranges that an instrument may cross: the last
    page is A, B, C or E, the next is none of B, F and U, and is C or E or goes on."""
    left = pages.select(*entity, F.col(position).alias(stop), F.col(role).alias("_left"))
    right = pages.select(*entity, F.col(position).alias("_next"), F.col(role).alias("_right"), F.col(continues).alias("_goes_on"))
    starts = ranges.select(*entity, F.col(start).alias("_next"))
    border = ranges.select(*entity, stop).withColumn("_next", F.col(stop) + 1).join(starts, [*entity, "_next"])
    both = border.join(left, [*entity, stop]).join(right, [*entity, "_next"])
    may = F.col("_left").isin("A", "B", "C", "E") & ~F.col("_right").isin("B", "F", "U") & (F.col("_right").isin("C", "E") | F.col("_goes_on").isNotNull())
    return both.where(may).select(*entity, stop, F.col("_next").alias(start))


def repaired_roles(pages: DataFrame, entity: list[str], position: str, role: str, counter: str, continues: str, supported: Column, closing: Column) -> DataFrame:
    """``pages`` with ``resolved`` and ``reason``: a chain of pages that printed counters hold together
    becomes A C ... C E. A chain begins at an A or B whose counter is (1, k), k > 1, and goes on over
    consecutive pages that continue, are ``supported`` (C and E always are) and are none of A, B, F
    and U. It counts if it has two pages or more and its last is E, ``closing``, or bears (k, k) as the k-th.

    Chains are islands of running sums over a window by document and ``continues``; a page belongs to
    the chain of the nearest begin before it if nothing between breaks it. Positions must not repeat.
    """
    w = Window.partitionBy(*entity).orderBy(position)
    c = F.col(counter)
    begins = F.coalesce(F.col(role).isin("A", "B") & (c["page"] == 1) & (c["of"] > 1), F.lit(False))
    adjacent = F.coalesce(F.col(position) == F.lag(position).over(w) + 1, F.lit(False))
    holds = F.col(continues).isNotNull() & ~F.col(role).isin("A", "B", "F", "U") & (F.col(role).isin("C", "E") | F.coalesce(supported, F.lit(False))) & adjacent
    island = F.sum(F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = pages.withColumn("_begins", begins).withColumn("_island", island)
    ends = F.when(F.col(role) == "E", F.lit(True)).otherwise(F.coalesce(closing, F.lit(False)))
    chains = marked.groupBy(*entity, "_island").agg(
        F.min(position).alias("_from"), F.max(position).alias("_to"), F.count("*").alias("_n"), F.min_by("_begins", position).alias("_starts"), F.max_by(ends, position).alias("_ends"),
        F.min_by(c["of"], position).alias("_of"), F.max_by(F.struct(c["page"].alias("page"), c["of"].alias("of")), position).alias("_last"),
    )
    full = (F.col("_last.page") == F.col("_of")) & (F.col("_last.of") == F.col("_of")) & (F.col("_of") == F.col("_n"))
    good = chains.where(F.col("_starts") & (F.col("_n") > 1) & (F.col("_ends") | F.coalesce(full, F.lit(False)))).select(*entity, "_island", "_from", "_to")
    out = marked.join(good, [*entity, "_island"], "left")
    new = F.when(F.col("_from").isNull(), F.col(role)).when(F.col(position) == F.col("_from"), "A").when(F.col(position) == F.col("_to"), "E").otherwise("C")
    return out.withColumn("resolved", new).withColumn("reason", F.when(~F.col(role).eqNullSafe(F.col("resolved")), "numbered_continuation")).select(*pages.columns, "resolved", "reason")


def resolved_roles(pages: DataFrame, entity: list[str], position: str, role: str, independent: Column) -> DataFrame:
    """``pages`` with ``role`` set to N where a page is ``independent``, and ``reason`` where that changed it."""
    alone = F.coalesce(independent, F.lit(False)) & ~F.col(role).eqNullSafe(F.lit("N"))
    return pages.withColumn("reason", F.when(alone, "independent_document")).withColumn(role, F.when(alone, "N").otherwise(F.col(role)))


def needs_recognition(image_parts: Column, hidden_image: Column, body_chars: Column, faults: Column, drawings: Column) -> Column:
    """Whether a page's own text is not enough: an image of a twentieth of the page or more
    with hardly any text over it, much image and little text, faulty text, or drawings instead of text."""
    few, some, many = 80, 300, 80  # fixed values: characters of text, and drawings
    return F.coalesce(hidden_image | ((image_parts > 0.1) & (body_chars < some)) | (F.size(faults) > 0) | ((body_chars < few) & (drawings > many)), F.lit(False))


def hidden_image(rects: Column, words: Column, width: Column, height: Column) -> Column:
    """Whether an image of a twentieth of the page or more has under 80 characters of words wholly within it."""
    side = lambda r, a, b: F.greatest(r[b] - r[a], F.lit(0.0))
    within = lambda w, r: (w["x0"] >= r[0]) & (w["y0"] >= r[1]) & (w["x1"] <= r[2]) & (w["y1"] <= r[3])
    over = lambda r: F.reduce(F.filter(F.coalesce(words, F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>")), lambda w: within(w, r)), F.lit(0), lambda n, w: n + F.length(w["text"]))
    large = F.filter(rects, lambda r: side(r, 0, 2) * side(r, 1, 3) >= 0.05 * width * height)
    return F.coalesce(F.exists(large, lambda r: over(r) < 80), F.lit(False))
