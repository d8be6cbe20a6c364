"""Joining a large side with one row per key, whatever the sizes and the skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resma.plans.cut import cut

#: Fixed widths in bytes of a cell as it is held in a broadcast table.
_WIDTH = {T.ByteType: 8, T.ShortType: 8, T.IntegerType: 8, T.LongType: 8, T.FloatType: 8, T.DoubleType: 8, T.BooleanType: 8, T.DateType: 8, T.TimestampType: 8}


def byte_size(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` take; texts and nested values by their JSON."""
    fixed = 16 + sum(_WIDTH.get(type(f.dataType), 16) for f in df.schema)
    texts = [f.name for f in df.schema if type(f.dataType) not in _WIDTH]
    size = F.lit(fixed)
    for c in texts:
        kind = df.schema[c].dataType
        plain = isinstance(kind, (T.StringType, T.BinaryType, T.DecimalType))
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string") if plain else F.to_json(F.struct(c))), F.lit(0))
    return df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("n")).collect()[0]["n"]  # one row


def lookup(big: DataFrame, dim: DataFrame, key: str, how: str = "left", max_bytes: int = 64 << 20, salts: int = 32, cached: bool = False) -> DataFrame:
    """``big`` with the columns of ``dim``, which has at most one row for each ``key``.

    ``dim`` is materialised (unless ``cached`` says that it is) and its bytes are summed: up to
    ``max_bytes`` it is broadcast; beyond, its rows are repeated ``salts`` times and both sides
    are spread by (key, salt), so one key that holds a third of ``big`` goes to ``salts`` tasks.
    Null keys find nothing.
    """
    if not cached:
        dim = cut(dim)
    if byte_size(dim) <= max_bytes:
        return big.join(F.broadcast(dim), key, how)
    salted = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    return spread.join(salted, [key, "_salt"], how).drop("_salt")
