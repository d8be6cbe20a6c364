"""Sources mixed to target shares by weighted fair queueing.

Every text has a virtual finish time: the tokens of its source up to and with it, in shuffled
order, divided by the source's weight. Served in the order of these times, the sources keep
their shares all along; the order is cut where the total budget is reached. A source that is
repeated starts its next round where the last ended. Cumulative sums are made within hash
buckets and shifted by the buckets' totals, so no source and no stretch of time is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resma.plans.cut import cut

#: Rows of one bucket of the shuffled order of a source, or of virtual time, on average.
ROWS = 50_000


def running_total(rows: DataFrame, groups: list[str], bucket: str, order: list[str], amount: str, out: str) -> DataFrame:
    """``rows`` with the inclusive running sum of ``amount`` within ``groups`` in the order
    (bucket, order); one task never holds more than one bucket of one group."""
    sums = rows.groupBy(*groups, bucket).agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(*groups, bucket, F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.sum(amount).over(Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("_within", within).join(offsets, [*groups, bucket]).withColumn(out, F.col("_before") + F.col("_within")).drop("_before", "_within")


def one_of_each_text(docs: DataFrame, key: str, text_hash: list[str]) -> DataFrame:
    """The first document (by key) of each text, as no text may be used more often than its cap,
    with the number of documents (``copies``) that hold the text."""
    return docs.groupBy(*text_hash).agg(F.min(F.struct(key, *[c for c in docs.columns if c not in (key, *text_hash)])).alias("_first"), F.count("*").alias("copies")).select("_first.*", "copies")


def mix_budget(available: dict[str, int], share: dict[str, float], repeats: dict[str, int]) -> tuple[float, dict[str, float]]:
    """The largest total at which every source that has texts reaches its share within its
    repeats, and the weights; shares of sources without texts are spread over the others."""
    live = {s: w for s, w in share.items() if w and w > 0 and available.get(s, 0) > 0 and repeats.get(s, 0) > 0}
    whole = sum(live.values())
    weights = {s: w / whole for s, w in live.items()}
    return min((available[s] * repeats[s] / w for s, w in weights.items()), default=0.0), weights


def served_until(total: float, limits: dict[str, float], weights: dict[str, float], slack: float) -> float:
    """The virtual time after which nothing is served any more: by then the sources, each at its
    weight until it stops at its limit, have served ``total`` and ``slack`` (a text of each)."""
    goal = total + slack
    ends = sorted((limits[s] / w, s) for s, w in weights.items())
    done, speed, at = 0.0, sum(weights.values()), 0.0
    for end, s in ends:
        if done + speed * (end - at) >= goal:
            return at + (goal - done) / speed
        done, at, speed = done + speed * (end - at), end, speed - weights[s]
    return at


def mix(sized: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", tokens: str = "n_tokens", text_hash: tuple[str, ...] = (), seed: int = 17, budget: int | None = None, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    ``sized``: key, source, tokens and, if exact copies shall count as one text, the columns
    ``text_hash``. ``targets``: source, target_share, max_repeats. ``budget``: total tokens;
    without it the largest total at which all sources that have texts reach their shares.

    selection: key, source, tokens, copies (documents that hold the text, 1 without ``text_hash``),
    repeats (times used, 1 or more; texts not used are left out). shares: source, target_share,
    max_repeats, available_tokens, documents, selected_documents, selected_tokens, actual_share,
    most_repeats, for every row of ``targets``. Texts without tokens, of null sources or of sources
    without target are not mixed. A null or non-positive share or cap mixes nothing. With a given
    budget beyond what a source's cap allows, the source stops at its cap and falls short, as
    shares then tells. ``rows``: rows of a bucket; the result does not depend on it.
    """
    goals = [r.asDict() for r in targets.select("source", "target_share", "max_repeats").collect()]  # one row a source
    share = {g["source"]: g["target_share"] for g in goals if g["source"] is not None}
    cap = {g["source"]: g["max_repeats"] or 0 for g in goals if g["source"] is not None}
    asked = sized.where(F.col(source).isin(list(share)) & (F.col(tokens) > 0)) if share else sized.limit(0)
    asked = one_of_each_text(asked.select(key, source, tokens, *text_hash), key, list(text_hash)) if text_hash else asked.withColumn("copies", F.lit(1).cast("long"))
    shuffle = F.xxhash64(F.lit(seed), F.col(key))
    asked = cut(asked.select(key, source, F.col(tokens).cast("long").alias(tokens), "copies", shuffle.alias("_shuffle")))
    stock = {r[source]: (r["n"], r["t"], r["most"]) for r in asked.groupBy(source).agg(F.count("*").alias("n"), F.sum(tokens).alias("t"), F.max(tokens).alias("most")).collect()}
    most, weights = mix_budget({s: t for s, (_, t, _) in stock.items()}, share, cap)
    total = float(budget) if budget is not None else most
    constant = lambda of, kind: F.create_map(*[x for s, v in of.items() for x in (F.lit(s), F.lit(v))]) if of else F.create_map().cast(f"map<string,{kind}>")
    totals = constant({s: t for s, (_, t, _) in stock.items()}, "bigint")
    weight, caps = constant(weights, "double"), constant({s: int(c) for s, c in cap.items()}, "int")

    buckets = max(1, -(-sum(n for n, _, _ in stock.values()) // rows))
    parted = asked.withColumn("_bucket", F.floor((F.col("_shuffle") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    summed = running_total(parted.where(weight[F.col(source)].isNotNull()), [source], "_bucket", ["_shuffle", key], tokens, "_sum_to")
    # rounds that would end after the last moment at which anything is served are not made
    limits = {s: float(stock[s][1] * cap[s]) for s in weights}
    until = served_until(total, limits, weights, float(sum(stock[s][2] for s in weights)))
    own, held = weight[F.col(source)], totals[F.col(source)]
    last = F.least(caps[F.col(source)], (F.floor((F.lit(until) * own - F.col("_sum_to")) / held) + 1).cast("int"))
    rounds = summed.withColumn("_last", last).where(F.col("_last") >= 1).withColumn("_round", F.explode(F.sequence(F.lit(1), F.col("_last"))))
    queued = rounds.withColumn("_finish", ((F.col("_round") - 1) * held + F.col("_sum_to")) / own)
    # time is parted by the tokens served up to it, which is known: so many in every bucket, whatever the weights
    served_by = sum((F.least(F.lit(w) * F.col("_finish"), F.lit(limits[s])) for s, w in weights.items()), F.lit(0.0))
    whole = max(1.0, sum(min(w * until, limits[s]) for s, w in weights.items()))
    times = max(1, -(-sum(n * min(cap[s], int(until * weights[s] / max(1, t)) + 1) for s, (n, t, _) in stock.items() if s in weights) // rows))
    queued = queued.withColumn("_time", F.floor(served_by / whole * times).cast("int"))
    served = running_total(queued.withColumn("_all", F.lit(0)), ["_all"], "_time", ["_finish", source, key, "_round"], tokens, "_served")
    taken = served.where(F.col("_served") <= F.lit(total))
    selection = cut(taken.groupBy(key, source, tokens, "copies").agg(F.count("*").cast("int").alias("repeats")))

    used = selection.groupBy(source).agg(F.count("*").alias("selected_documents"), F.sum(F.col(tokens) * F.col("repeats")).alias("selected_tokens"), F.max("repeats").alias("most_repeats"))
    have = asked.groupBy(source).agg(F.count("*").alias("documents"), F.sum(tokens).alias("available_tokens"))
    all_tokens = selection.agg(F.sum(F.col(tokens) * F.col("repeats")).alias("_all"))
    named = targets.select(F.col("source").alias(source), "target_share", "max_repeats")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    shares = (
        named.join(have, source, "left").join(used, source, "left").crossJoin(F.broadcast(all_tokens))  # one row
        .select(source, "target_share", "max_repeats", zero("documents"), zero("available_tokens"), zero("selected_documents"), zero("selected_tokens"),
                (F.coalesce(F.col("selected_tokens"), F.lit(0)) / F.greatest(F.coalesce("_all", F.lit(0)), F.lit(1))).alias("actual_share"), zero("most_repeats"))
    )
    return selection, shares
