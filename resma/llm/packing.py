"""Texts placed into containers of fixed capacity: shortest-pack-first over the length histogram.

Only the histogram (at most one row per length up to the capacity) reaches the driver. There,
lengths are placed longest first, always into the packs with most room, as counts of packing
patterns; how many documents there are does not matter. The patterns then go back to the
executors, where each document finds its container by its rank among those of its length.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resma.plans.cut import cut

CAPACITY = 2048
#: Rows of one hash bucket over which the documents of one length are ranked, on average; a length
#: that a third of all texts have is ranked in as many parts as its rows ask for.
ROWS = 50_000


@dataclass
class Pattern:
    """``count`` packs that each hold the lengths ``items`` (longest first)."""

    items: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Packing patterns for ``histogram`` (length to number of items, lengths 1 to capacity).

    A length goes into the packs with most room as long as it fits; only when it fits into none
    are new packs begun. Packs of equal items are moved together as one count.
    """
    open_packs: dict[tuple[int, ...], int] = {}
    heap: list[tuple[int, tuple[int, ...]]] = []

    def put(items: tuple[int, ...], room: int, count: int) -> None:
        if count:
            if items not in open_packs:
                heapq.heappush(heap, (-room, items))
            open_packs[items] = open_packs.get(items, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and -heap[0][0] >= length:
                room, items = -heap[0][0], heap[0][1]
                heapq.heappop(heap)
                have = open_packs.pop(items)
                take = min(have, left)
                put(items, room, have - take)
                put((*items, length), room - length, take)
                left -= take
            else:
                each = capacity // length
                put((length,) * each, capacity - each * length, left // each)
                put((length,) * (left % each), capacity - left % each * length, 1 if left % each else 0)
                left = 0
    return [Pattern(items, count) for items, count in sorted(open_packs.items(), reverse=True)]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int, int, int]]:
    """(length, first rank, past rank, container of the first, items per container, place of the
    first, start of the first, fill): which ranks of a length go to which containers."""
    given: Counter[int] = Counter()
    out = []
    container = 0
    for p in patterns:
        place = start = 0
        fill = sum(p.items)
        for length, each in Counter(p.items).items():
            n = each * p.count
            out.append((length, given[length], given[length] + n, container, each, place, start, fill))
            given[length] += n
            place += each
            start += each * length
        container += p.count
    return out


def pieces(sized: DataFrame, capacity: int = CAPACITY, tokens: str = "n_tokens") -> DataFrame:
    """``sized`` with one row per piece: texts longer than the capacity are divided into full
    pieces and a rest; columns piece (from 0), piece_from (token) and piece_tokens."""
    full = F.greatest(F.ceil(F.col(tokens) / F.lit(capacity)).cast("int"), F.lit(1))
    each = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), full - 1)))
    start = F.col("piece") * F.lit(capacity)
    return each.withColumn("piece_from", start).withColumn("piece_tokens", F.least(F.lit(capacity), F.col(tokens) - start).cast("int"))


def ranked(items: DataFrame, length: str, order: list[str], buckets: int) -> DataFrame:
    """``items`` with ``rank`` (from 0) among those of the same length, without ever bringing
    the items of one length together: ranks within hash buckets plus the buckets' offsets."""
    bucketed = items.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy(length, "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(length, "_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(length, "_bucket").orderBy(*order)) - 1
    return bucketed.withColumn("_within", within).join(offsets, [length, "_bucket"]).withColumn("rank", F.col("_offset") + F.col("_within")).drop("_bucket", "_within", "_offset")


def pack(sized: DataFrame, key: str = "doc_id", tokens: str = "n_tokens", capacity: int = CAPACITY, rows: int = ROWS) -> DataFrame:
    """Container and place of each piece of each text.

    ``sized`` has one row per text with ``key`` and ``tokens``. Result: key, piece, piece_from,
    piece_tokens, container, place (from 0), start (tokens before it in the container) and
    fill (tokens in the container). Texts without tokens (null, empty) take no room and have
    null container, place, start and fill. A repeated key counts as another text. An empty table gives
    an empty result. The result does not depend on the order or partitioning of the input.
    ``rows``: rows of a ranking bucket; which of the texts of one length go where depends on it.
    """
    spark: SparkSession = sized.sparkSession
    items = cut(pieces(sized.select(key, F.coalesce(F.col(tokens), F.lit(0)).alias(tokens)), capacity, tokens).drop(tokens))
    histogram = {r["piece_tokens"]: r["n"] for r in items.where(F.col("piece_tokens") > 0).groupBy("piece_tokens").agg(F.count("*").alias("n")).collect()}
    found = slots(shortest_pack_first(histogram, capacity))
    schema = "piece_tokens int, _from long, _to long, _container long, _each int, _place int, _start int, fill int"
    # at most one row per length of each pattern: bounded by the capacity, not by the data
    table = F.broadcast(spark.createDataFrame(found, schema))
    # as many buckets as the most frequent length needs
    order = ranked(items.where(F.col("piece_tokens") > 0), "piece_tokens", [key, "piece"], max(1, -(-max(histogram.values(), default=0) // rows)))
    placed = order.join(table, (order["piece_tokens"] == table["piece_tokens"]) & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to"))).drop(table["piece_tokens"])
    nth = F.col("rank") - F.col("_from")
    each = F.col("_each").cast("long")
    turn = (nth % each).cast("int")
    result = placed.select(
        key, "piece", "piece_from", "piece_tokens",
        (F.col("_container") + F.floor(nth / each)).cast("long").alias("container"),
        (F.col("_place") + turn).alias("place"),
        (F.col("_start") + turn * F.col("piece_tokens")).alias("start"),
        "fill",
    )
    none = items.where(F.col("piece_tokens") <= 0)
    empty = none.select(key, "piece", "piece_from", "piece_tokens", *[F.lit(None).cast(t).alias(c) for c, t in (("container", "long"), ("place", "int"), ("start", "int"), ("fill", "int"))])
    return result.unionByName(empty)


def container_fills(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Fill of each container: container, pieces, fill, unused."""
    filled = packed.where(F.col("container").isNotNull()).groupBy("container").agg(F.count("*").alias("pieces"), F.sum("piece_tokens").alias("fill"))
    return filled.withColumn("unused", F.lit(capacity) - F.col("fill"))
