"""Near copies among texts: every pair whose words overlap enough, and the first text of each class."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resma.functions import text
from resma.plans.cut import cut
from resma.plans.spread import spread

#: Least share of common words, as a fraction: 0.55.
LEAST = (11, 20)
#: Ratio of the word counts of a band.
STEP = 1.35
#: Words of all texts of one side of a tile; texts and different words compared at once.
SIDE, BLOCK, WORDS = 2_000_000, 1000, 2048


def overlapping(flat: tuple[np.ndarray, np.ndarray], lengths: tuple[np.ndarray, np.ndarray], least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (left, right) of the sets that overlap by ``least``; sets are given flat, with their lengths."""
    words, places = np.unique(np.concatenate(flat), return_inverse=True)
    n = len(flat[0])
    blocks: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []  # of sets in order of length: places, and cells of their words
    for m, word in zip(lengths, (places[:n], places[n:])):
        order = np.argsort(m, kind="stable")
        ends = np.cumsum(m)
        side = []
        for i in range(0, len(m), BLOCK):
            at = order[i : i + BLOCK]
            held = np.concatenate([word[ends[k] - m[k] : ends[k]] for k in at])
            side.append((at, np.repeat(np.arange(len(at)), m[at]), held))
        blocks.append(side)
    found = []
    for at, row, held in blocks[0]:
        a = lengths[0][at]
        for at2, row2, held2 in blocks[1]:
            b = lengths[1][at2]
            if least[1] * a[-1] < least[0] * b[0] or least[1] * b[-1] < least[0] * a[0]:
                continue
            common = np.zeros((len(at), len(at2)), np.float32)
            for start in range(0, len(words), WORDS):
                width = min(WORDS, len(words) - start)
                sides = []
                for r, h, size in ((row, held, len(at)), (row2, held2, len(at2))):
                    here = (h >= start) & (h < start + width)
                    side = np.zeros((size, width), np.float32)
                    side[r[here], h[here] - start] = 1
                    sides.append(side)
                common += sides[0] @ sides[1].T
            x, y = np.nonzero((least[0] + least[1]) * common >= least[0] * (a[:, None] + b[None, :]))
            found.append((at[x], at2[y]))
    x, y = zip(*found) if found else ([np.zeros(0, int)], [np.zeros(0, int)])
    return np.concatenate(x), np.concatenate(y)


def overlapping_pairs(sets: DataFrame, key: str, words: str, least: tuple[int, int] = LEAST, side: int = SIDE) -> DataFrame:
    """(low, high) of all pairs of rows whose sets of words have a Jaccard index of ``least`` or more.

    ``words``: array<long> without repeats. Sets that overlap so have sizes of at least that
    ratio, so rows are put into bands by size and only bands within the ratio are compared: no
    pair is lost. Bands are parted into sides of about ``side`` words; two sides are a tile,
    compared by matrix products, whatever the words. Empty sets are like no other.
    """
    far = math.floor(math.log(least[1] / least[0]) / math.log(STEP)) + 1
    kind = sets.schema[key].dataType.simpleString()
    rows = cut(sets.where(F.size(words) > 0).select(F.col(key).alias("k"), F.col(words).alias("w"), F.floor(F.log(F.size(words)) / math.log(STEP)).cast("int").alias("band")))
    bands = cut(rows.groupBy("band").agg(F.ceil(F.sum(F.size("w")) / side).cast("int").alias("parts")))
    rows = rows.join(F.broadcast(bands), "band").withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int")).drop("parts")  # one row per band
    sides = bands.select("band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    a, b = sides.toDF("band", "part"), sides.toDF("band2", "part2")
    fits = (F.col("band2") > F.col("band")) & (F.col("band2") <= F.col("band") + far) | (F.col("band2") == F.col("band")) & (F.col("part2") >= F.col("part"))
    tiles = cut(a.join(F.broadcast(b), fits))
    left = rows.join(tiles, ["band", "part"]).withColumn("right", F.lit(False))
    other = tiles.select(F.col("band").alias("b"), F.col("part").alias("p"), F.col("band2").alias("band"), F.col("part2").alias("part"))
    same = (F.col("b") == F.col("band")) & (F.col("p") == F.col("part"))
    right = rows.join(other.where(~same), ["band", "part"]).select("k", "w", F.col("b").alias("band"), F.col("p").alias("part"), F.col("band").alias("band2"), F.col("part").alias("part2"), F.lit(True).alias("right"))

    def compare(tile: pa.Table) -> pa.Table:
        at = tile.column("right").to_numpy()
        keys, held = tile.column("k").combine_chunks(), tile.column("w").combine_chunks()
        places = [np.flatnonzero(~at), np.flatnonzero(at)]
        within = not at.any() and tile.column("band")[0] == tile.column("band2")[0] and tile.column("part")[0] == tile.column("part2")[0]
        if within:
            places[1] = places[0]
        if not len(places[0]) or not len(places[1]):
            return pa.table({"a": keys[:0], "b": keys[:0]})
        taken = [held.take(pa.array(p)) for p in places]
        x, y = overlapping(tuple(t.flatten().to_numpy() for t in taken), tuple(t.value_lengths().to_numpy() for t in taken), least)
        if within:
            x, y = x[x < y], y[x < y]
        return pa.table({"a": keys.take(pa.array(places[0][x])), "b": keys.take(pa.array(places[1][y]))})

    names = ["band", "part", "band2", "part2"]
    pairs = left.select("k", "w", *names, "right").unionByName(right).groupBy(*names).applyInArrow(compare, f"a {kind}, b {kind}")
    return pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high")


def joined_copies(pairs: DataFrame) -> DataFrame:
    """(key, first): rows that are no representatives, with the first one they are like.

    In order of the keys, a row that is like an earlier representative joins the first such, any
    other row is a representative. Rounds decide all rows whose earlier neighbours are decided.
    """
    left = pairs = cut(pairs)
    joined = pairs.select(F.col("high").alias("key")).limit(0)
    while not left.isEmpty():
        roots = left.select("low").distinct().join(left.select(F.col("high").alias("low")).distinct(), "low", "left_anti")
        found = cut(left.join(roots, "low").select(F.col("high").alias("key")).distinct())
        joined = joined.union(found)
        left = cut(left.join(found.withColumnRenamed("key", "high"), "high", "left_anti").join(found.withColumnRenamed("key", "low"), "low", "left_anti"))
    from_first = pairs.join(joined.withColumnRenamed("key", "low"), "low", "left_anti").join(joined.withColumnRenamed("key", "high"), "high", "left_semi")
    return from_first.groupBy(F.col("high").alias("key")).agg(F.min("low").alias("first"))


def near_classes(docs: DataFrame, key: str = "doc_id", content: str = "text", least: tuple[int, int] = LEAST, side: int = SIDE) -> DataFrame:
    """(key, class_id): equal texts are one; of different texts the first representative wins
    whose words (``text.tokens``, as hashes of 64 bits) have a Jaccard index of ``least`` or more.

    Null texts have no class; texts without such words are only like equal ones.
    """
    texts = spread(docs.where(F.col(content).isNotNull()).select(F.col(key).alias("key"), F.col(content).alias("text")))
    hashed = cut(texts.select("key", F.unhex(F.sha2("text", 256)).alias("h")))
    firsts = cut(hashed.groupBy("h").agg(F.min("key").alias("key")))
    distinct = texts.join(firsts.select("key"), "key", "left_semi")
    sets = distinct.select("key", F.transform(text.tokens(text.normalized(F.col("text"))), lambda w: F.xxhash64(w)).alias("words"))
    joined = joined_copies(overlapping_pairs(sets, "key", "words", least, side))
    classes = firsts.join(joined, "key", "left").select("h", F.coalesce("first", "key").alias("class_id"))
    return hashed.join(classes, "h").select(F.col("key").alias(key), "class_id")


def equal_lists(items: DataFrame, entity: list[str], order: str, content: str, name: str) -> DataFrame:
    """(fingerprint, first_<...>, copies, sources) of entities whose items, in order, are equal.
    Each item is hashed where it is read, so an entity's list is one of hashes."""
    parts = items.select(*entity, F.struct(order, F.coalesce(content, F.lit("")).alias("t")).alias("p"))
    whole = parts.groupBy(*entity).agg(F.sort_array(F.collect_list("p")).alias("ps"))
    marked = whole.select(*entity, F.sha2(F.array_join(F.transform("ps", lambda p: p["t"]), "\x1f"), 256).alias("fingerprint"))
    return marked.groupBy("fingerprint").agg(F.min(name).alias("first_source"), F.count("*").alias("copies"), F.sort_array(F.collect_list(name)).alias("sources"))
