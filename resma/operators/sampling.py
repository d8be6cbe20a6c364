"""Reproducible samples: seeded order, quotas over strata, splits and their report."""

from __future__ import annotations

import random
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resma.functions.numbers import seeded_rank
from resma.plans.lookup import lookup


#: Parts into which a stratum is split before its first rows meet.
PARTS = 64


def uniform_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The first ``n`` rows in seeded order; the same for any order of the input."""
    return df.withColumn("rank", seeded_rank(seed, F.col(key))).orderBy("rank", key).limit(n)


def stratum(*columns: str) -> F.Column:
    """One text for a combination of values; null differs from any text."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def quotas(strata: DataFrame, n: int, seed: int, key: str = "stratum", size: str = "size") -> DataFrame:
    """(stratum, size, quota): one seat per stratum and the rest in proportion to size, by
    largest remainder; ties go by the seeded rank of the stratum. With fewer seats than strata
    no stratum has a quota (null). ``strata`` has one row per stratum."""
    total = strata.agg(F.count("*").alias("k"), F.sum(size).alias("rows"))
    each = strata.crossJoin(F.broadcast(total))  # one row
    seats = F.least(F.lit(n), F.col("rows")) - F.col("k")
    product, room = seats * (F.col(size) - 1), F.col("rows") - F.col("k")
    each = each.withColumn("_share", F.when(room > 0, F.floor(product / room)).otherwise(0)).withColumn("_rest", F.when(room > 0, product % room).otherwise(0))
    w = Window.orderBy(F.desc("_rest"), seeded_rank(seed, F.col(key)))  # one row per stratum
    given = F.sum("_share").over(Window.partitionBy())
    extra = F.row_number().over(w) <= seats - given
    quota = F.when(seats >= 0, 1 + F.col("_share") + F.when(extra, 1).otherwise(0))
    return each.select(key, size, quota.cast("long").alias("quota"))


def quota_sample(df: DataFrame, key: str, stratum_column: str, n: int, seed: int) -> DataFrame:
    """Every stratum by its quota, within it by seeded rank; falls back to a uniform sample when
    there are more strata than seats."""
    sizes = df.groupBy(stratum_column).agg(F.count("*").alias("size"))
    quota = quotas(sizes, n, seed, stratum_column)
    ranked = df.withColumn("rank", seeded_rank(seed, F.col(key)))
    joined = lookup(ranked, quota.drop("size"), stratum_column, how="inner")
    # a stratum may hold most rows: the first of each part of it are told before they meet
    parts = Window.partitionBy(stratum_column, F.pmod(F.xxhash64(key), F.lit(PARTS))).orderBy("rank", key)
    first = joined.withColumn("_nth", F.row_number().over(parts)).where(F.col("_nth") <= F.col("quota"))
    whole = Window.partitionBy(stratum_column).orderBy("rank", key)
    picked = first.withColumn("_nth", F.row_number().over(whole)).where(F.col("_nth") <= F.col("quota")).drop("_nth", "quota")
    few = joined.where(F.col("quota").isNull()).drop("quota").orderBy("rank", key).limit(n)
    return picked.unionByName(few)


def covering_sample(df: DataFrame, key: str, stratum_column: str, group: str, n: int, seed: int) -> DataFrame:
    """A quota sample that within strata prefers groups not yet seen, then those least sampled.

    Choosing is one row after another, so the candidates are first cut to what can be chosen:
    of each stratum and group the first ``quota`` rows in seeded order (a row beyond these is
    never the best). That is at most n rows per group of each stratum, whatever the table's size.
    Null is a group of its own, and a stratum.
    """
    # texts that are never null, so that rows of null groups and strata find their counts
    named = df.select(F.col(key), stratum(stratum_column).alias("_stratum"), stratum(group).alias("_group"), F.coalesce(seeded_rank(seed, F.col(stratum_column)), F.lit("")).alias("stratum_rank"))
    sizes = df.groupBy(stratum_column).agg(F.count("*").alias("size"))
    quota = quotas(sizes, n, seed, stratum_column).select(stratum(stratum_column).alias("_stratum"), "size", "quota")
    population = named.groupBy("_group").agg(F.count("*").alias("population"))
    ranked = named.withColumn("rank", seeded_rank(seed, F.col(key)))
    nth = F.row_number().over(Window.partitionBy("_stratum", "_group").orderBy("rank", key))
    cut = ranked.join(quota, "_stratum").withColumn("_nth", nth)
    can = cut.where(F.coalesce(F.col("_nth") <= F.col("quota"), F.col("_nth") <= n)).join(population, "_group")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rank", key])
        if rows["quota"].isna().any():
            return rows.head(n)[[key]]
        pools = {s: g.to_dict("records") for s, g in rows.groupby("_stratum")}
        order = sorted(pools, key=lambda s: (pools[s][0]["size"], pools[s][0]["stratum_rank"]))
        left = {s: int(pools[s][0]["quota"]) for s in order}
        seen: dict[object, int] = {}
        out = []
        while any(left.values()):
            for s in order:
                if not left[s]:
                    continue
                best = min(pools[s], key=lambda r: (seen.get(r["_group"], 0) > 0, seen.get(r["_group"], 0) / r["population"], r["rank"]))
                pools[s].remove(best)
                left[s] -= 1
                seen[best["_group"]] = seen.get(best["_group"], 0) + 1
                out.append(best[key])
        return pd.DataFrame({key: out})

    chosen = can.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(choose, f"`{key}` {df.schema[key].dataType.simpleString()}")
    return df.join(chosen, key).withColumn("rank", seeded_rank(f"{seed}:order", F.col(key)))


def split(df: DataFrame, key: str, sizes: dict[str, int], seed: int) -> DataFrame:
    """``df`` rows with ``role``: the first rows in seeded order go to the first role, the next
    to the second and so on; the roles are disjoint, the rest has no row."""
    most = sum(sizes.values())
    first = df.withColumn("rank", seeded_rank(seed, F.col(key))).orderBy("rank", key).limit(most)
    place = F.row_number().over(Window.orderBy("rank", key))  # at most the sum of the sizes
    role, upto = F.lit(None).cast("string"), most
    for name in reversed(list(sizes)):
        role = F.when(F.col("_place") <= upto, F.lit(name)).otherwise(role)
        upto -= sizes[name]
    return first.withColumn("_place", place).withColumn("role", role).drop("_place")


def checked_split(df: DataFrame, keys: list[str], sizes: dict[str, int], seed: int) -> DataFrame:
    """``split`` by the first of ``keys``, refused where there are fewer rows than seats or a value
    of any of ``keys`` would stand in two roles."""
    chosen = split(df, keys[0], sizes, seed)
    have = chosen.count()
    if have < sum(sizes.values()):
        raise ValueError(f"{have} rows for {sum(sizes.values())} seats")
    for k in keys:  # at most the sum of the sizes
        if not chosen.where(F.col(k).isNotNull()).groupBy(k).agg(F.countDistinct("role").alias("roles")).where("roles > 1").isEmpty():
            raise ValueError(f"roles share a {k}")
    return chosen


def prng_split(df: DataFrame, key: str, sizes: dict[str, int], seed: int) -> DataFrame:
    """(key, role): each role drawn by Python's generator (seed, seed + 1, ...) from the keys in
    order that no earlier role has. The keys come to the driver: for catalogs, not for corpora;
    ``split`` is the form without that bound."""
    left = sorted(r[key] for r in df.select(key).distinct().collect())
    rows = []
    for i, (role, n) in enumerate(sizes.items()):
        if n > len(left):
            raise ValueError(f"{len(left)} rows for {n} seats")
        drawn = set(random.Random(seed + i).sample(left, n))
        rows += [(k, role) for k in sorted(drawn)]
        left = [k for k in left if k not in drawn]
    return df.sparkSession.createDataFrame(rows, f"`{key}` {df.schema[key].dataType.simpleString()}, role string")


def split_summary(corpus: DataFrame, available: Column, excluded: Column, role: str = "role") -> DataFrame:
    """One row: rows of the corpus, available ones, excluded ones, and those of each part."""
    return corpus.agg(F.count("*").alias("corpus"), F.count_if(F.coalesce(available, F.lit(False))).alias("available"), F.count_if(F.coalesce(excluded, F.lit(False))).alias("excluded"), F.count(role).alias("chosen"))


def sampling_report(population: DataFrame, selected: DataFrame, key: str, dimensions: list[str]) -> DataFrame:
    """(dimension, value, population, selected) for every value of every dimension, in one pass
    over the rows; null values count as the text ``null``."""
    marked = population.select(key, *dimensions).join(selected.select(key).withColumn("_in", F.lit(1)), key, "left")
    values = reduce(lambda m, d: [*m, F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("null")).alias("value"))], dimensions, [])
    long = marked.select(F.explode(F.array(*values)).alias("v"), "_in")
    return long.groupBy("v.dimension", "v.value").agg(F.count("*").alias("population"), F.count("_in").alias("selected"))


def profile_sample(df: DataFrame, key: str, groups: list[str], profiles: list[tuple[str, int]], seed: int) -> DataFrame:
    """Rows picked profile by profile, each time preferring groups not yet seen.

    ``profiles``: boolean columns with the number of rows to pick for each, in order; a row is
    picked once. Among the rows of a profile the next one is that of the fewest groups seen
    before, in the order of ``groups``, then of seeded rank. Before choosing, each profile is
    cut to the first rows (as many as all picks) of each combination of groups, as no other can
    ever be picked. Result: key, place (from 1).
    """
    total = sum(n for _, n in profiles)
    flags = [p for p, _ in profiles]
    ranked = df.select(key, *groups, *flags).withColumn("rank", seeded_rank(seed, F.col(key)))
    can = None
    for flag in flags:
        nth = F.row_number().over(Window.partitionBy(*groups).orderBy("rank", key))
        part = ranked.where(F.col(flag)).withColumn("_nth", nth).where(F.col("_nth") <= total).drop("_nth")
        can = part if can is None else can.unionByName(part)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        pool = rows.drop_duplicates(key).sort_values(["rank", key]).to_dict("records")
        seen: list[set] = [set() for _ in groups]
        out: list[object] = []
        for flag, n in profiles:
            for _ in range(n):
                fit = [r for r in pool if r[flag]]
                if not fit:
                    break
                best = min(fit, key=lambda r: (*[r[g] in s for g, s in zip(groups, seen)], r["rank"]))
                pool.remove(best)
                out.append(best[key])
                for g, s in zip(groups, seen):
                    s.add(best[g])
        return pd.DataFrame({key: out, "place": range(1, len(out) + 1)})

    return can.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(choose, f"`{key}` {df.schema[key].dataType.simpleString()}, place int")
