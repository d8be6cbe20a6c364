"""Results held against a reference: each reference item is used once, denominators stay explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matched(predicted: DataFrame, occurrences: DataFrame, entity: str, item: str, gold: str, pages: str = "pages") -> DataFrame:
    """(entity, item, gold, verdict) of each predicted item.

    ``predicted``: entity, item, pages (array). ``occurrences``: entity, gold, pages, one row per
    place where a reference item occurs. verdict: ``exact`` (same pages; the n-th predicted item
    with these pages takes the n-th reference item that has them), ``boundary`` (pages overlap a reference item)
    or ``false``. Pages are compared as sets in order; null pages are false.
    """
    norm = lambda c: F.array_sort(F.array_distinct(c))
    p = predicted.select(entity, item, norm(F.col(pages)).alias("_pages"))
    # reference items that share a page list with another one are told apart by their rank
    g = occurrences.select(entity, gold, norm(F.col(pages)).alias("_pages")).distinct()
    nth_p = F.row_number().over(Window.partitionBy(entity, "_pages").orderBy(item))
    nth_g = F.row_number().over(Window.partitionBy(entity, "_pages").orderBy(gold))
    pairs = p.withColumn("_nth", nth_p).join(g.withColumn("_nth", nth_g), [entity, "_pages", "_nth"]).select(entity, item, gold)
    # a reference item found at two of its places counts for the first predicted item
    first = F.row_number().over(Window.partitionBy(entity, gold).orderBy(item))
    exact = pairs.withColumn("_nth", first).where(F.col("_nth") == 1).drop("_nth")
    page_p = p.select(entity, item, F.explode("_pages").alias("page"))
    page_g = g.select(entity, F.explode("_pages").alias("page")).distinct()
    touching = page_p.join(page_g, [entity, "page"], "left_semi").select(entity, item).distinct().withColumn("_touches", F.lit(True))
    out = p.join(exact, [entity, item], "left").join(touching, [entity, item], "left")
    verdict = F.when(F.col(gold).isNotNull(), "exact").when(F.col("_touches"), "boundary").otherwise("false")
    return out.select(entity, item, gold, verdict.alias("verdict"))


#: Counters of an entity; all sums of totals.
COUNTERS = (
    "gold", "produced", "delivered", "exact", "useful", "delivered_good", "missed", "false_outputs", "boundaries", "residual_pages", "damaged_pages", "quarantined",
    "clean_outputs", "preserved_outputs", "uncertain_outputs", "foreign_pages",
)


def scores(verdicts: DataFrame, golds: DataFrame, entity: str, item: str, gold: str, reviews: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """The COUNTERS by entity, with status and source_uncertain.

    ``reviews``: entity, item, delivered (boolean), residual, damaged, foreign (numbers of pages),
    uncertain (boolean); nulls count as not delivered, 0 and certain; an item without a review is
    delivered and faultless. useful: exact, delivered, certain and without any such page. ``sources``:
    entity, status, uncertain. An entity with golds only has produced nothing, one with items only no golds.
    """
    flags = {"delivered": "boolean", "residual": "long", "damaged": "long", "foreign": "long", "uncertain": "boolean"}
    if reviews is None:
        told = verdicts.select(entity, item, "verdict", *[F.lit(c == "delivered" if t == "boolean" else 0).cast(t).alias(c) for c, t in flags.items()])
    else:
        known = reviews.select(entity, item, *[F.coalesce(F.col(c), F.lit(False if t == "boolean" else 0)).cast(t).alias(c) for c, t in flags.items()])
        told = verdicts.select(entity, item, "verdict").join(known, [entity, item], "left").fillna(0, ["residual", "damaged", "foreign"]).fillna(False, ["uncertain"]).fillna(True, ["delivered"])
    exact = F.col("verdict") == "exact"
    clean, preserved = (F.col("residual") == 0) & ~F.col("uncertain"), (F.col("damaged") == 0) & ~F.col("uncertain")
    useful = exact & F.col("delivered") & clean & preserved & (F.col("foreign") == 0)
    counts = {
        "produced": F.lit(True), "delivered": F.col("delivered"), "exact": exact, "useful": useful, "delivered_good": useful, "false_outputs": F.col("verdict") == "false",
        "boundaries": F.col("verdict") == "boundary", "quarantined": ~F.col("delivered"), "clean_outputs": clean, "preserved_outputs": preserved, "uncertain_outputs": F.col("uncertain"),
    }
    made = told.groupBy(entity).agg(*[F.count_if(c).alias(n) for n, c in counts.items()], *[F.sum(c).alias(f"{c}_pages") for c in ("residual", "damaged", "foreign")])
    want = golds.select(entity, gold).distinct().groupBy(entity).agg(F.count("*").alias("gold"))
    both = want.join(made, entity, "full_outer")
    if sources is not None:
        both = both.join(sources.select(entity, "status", F.coalesce("uncertain", F.lit(False)).alias("source_uncertain")), entity, "full_outer")
    else:
        both = both.withColumn("status", F.lit(None).cast("string")).withColumn("source_uncertain", F.lit(False))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = both.select(entity, *[zero(c) for c in COUNTERS if c != "missed"], "status", F.coalesce("source_uncertain", F.lit(False)).alias("source_uncertain"))
    return out.withColumn("missed", F.col("gold") - F.col("exact"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the denominator is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


#: Ratios of totals: what over what.
RATIOS = {
    "coverage": ("useful", "gold"), "reliability": ("delivered_good", "delivered"), "recall": ("exact", "gold"), "precision": ("exact", "produced"),
    "cleaning_rate": ("clean_outputs", "produced"), "preservation_rate": ("preserved_outputs", "produced"),
}


def totals(scored: DataFrame, least: float = 0.8, pending: int = 0) -> DataFrame:
    """One row: the sums of COUNTERS, the RATIOS, numbers of entities (positive, negative,
    false_positive, needing_review, error, inconclusive) and passed: coverage and reliability reach
    ``least``, nothing is pending and no source is uncertain. A missing ratio does not pass."""
    n = {
        "positive": F.col("gold") > 0, "negative": F.col("gold") == 0, "false_positive": (F.col("gold") == 0) & (F.col("produced") > 0),
        "needing_review": F.col("status") == "needs_review", "error": F.col("status") == "error", "inconclusive": F.col("source_uncertain"),
    }
    t = scored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], *[F.count_if(c).alias(k) for k, c in n.items()])
    t = t.withColumns({k: ratio(F.col(a), F.col(b)) for k, (a, b) in RATIOS.items()})
    reached = (F.col("coverage") >= least) & (F.col("reliability") >= least) & (F.col("inconclusive") == 0) & F.lit(pending == 0)
    return t.withColumn("passed", F.coalesce(reached, F.lit(False)))


def same_sets(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, repeats counted."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def sum_if_all(x: Column) -> Column:
    """The sum if every row has a value, else null."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))
