"""Identifiers: check digits, name-based UUIDs, seeded ranks, content paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def process_digits(x: Column) -> Column:
    """The 20 digits of a well-formed process number with right check digits, else null."""
    well = x.rlike(r"^[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}\z")
    digits = F.regexp_replace(x, "[^0-9]", "")
    body = F.concat(F.substring(digits, 1, 7), F.substring(digits, 10, 11), F.lit("00")).try_cast("decimal(38,0)")
    right = F.lit(98) - body % F.lit(97) == F.substring(digits, 8, 2).try_cast("int")
    return F.when(well & right, digits)


def process_year(x: Column) -> Column:
    return F.substring(process_digits(x), 10, 4).cast("int")


def valid_cpf(x: Column) -> Column:
    """Whether the digits of ``x`` are a tax number with right check digits (all equal ones are none)."""
    digits = F.regexp_replace(x, "[^0-9]", "")

    def check(n: int) -> Column:
        total = sum((F.substring(digits, i + 1, 1).try_cast("int") * (n + 1 - i) for i in range(n)), F.lit(0))
        return (total * 10) % 11 % 10 == F.substring(digits, n + 1, 1).try_cast("int")

    return F.coalesce((F.length(digits) == 11) & ~digits.rlike(r"^(\d)\1{10}$") & check(9) & check(10), F.lit(False))


def uuid5(name: Column, namespace: str = NAMESPACE_URL) -> Column:
    """The name-based UUID (version 5) of ``name``."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def seeded_rank(seed: int | str, x: Column) -> Column:
    """A reproducible order that is unrelated to the values: SHA-256 of "seed:value"."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), x), 256)


def canonical_digest(**members: Column) -> Column:
    """SHA-256 of the values as a JSON object, members in order of name; null members are left out."""
    return F.sha2(F.to_json(F.struct(*[members[k].alias(k) for k in sorted(members)])), 256)


def document_path(number: Column, retrieved: Column, sha256: Column) -> Column:
    """Content-addressed place of a document: <year>/<digits>/<number>__<time>__<hash>.pdf"""
    digits = F.regexp_replace(number, "[^0-9]", "")
    time = F.regexp_replace(F.substring(retrieved, 1, 19), "[-:]", "")
    return F.concat(F.substring(digits, 10, 4), F.lit("/"), digits, F.lit("/"), number, F.lit("__"), time, F.lit("__"), F.substring(sha256, 1, 12), F.lit(".pdf"))


def retry_wait(attempt: Column, retry_after: Column, now: Column, waits: tuple[float, ...] = (5.0, 15.0)) -> Column:
    """Seconds until the next attempt: what a Retry-After header asks (seconds or an HTTP date,
    in UTC), else the wait of the attempt (from 1), the last one for all further."""
    seconds = F.when(retry_after.rlike(r"^\s*\d+\s*\z"), F.trim(retry_after).try_cast("double"))
    moment = F.try_to_timestamp(F.substring(F.trim(retry_after), 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))
    until = F.when(moment.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(moment) - F.unix_micros(now)) / 1e6))
    own = F.element_at(F.array(*map(F.lit, waits)), F.least(F.greatest(attempt, F.lit(1)), F.lit(len(waits))))
    return F.coalesce(seconds, until, own)


def retry(attempt: Column, retry_after: Column, now: Column, jitter: Column, pause: float = 60.0, waits: tuple[float, ...] = (5.0, 15.0)) -> Column:
    """struct<wait, pause>: ``retry_wait``, to which ``jitter`` (seconds) is added where the server
    asks for no time of its own, and whether what it asks is so long that the batch pauses."""
    asked = retry_wait(F.lit(1), retry_after, now, (-1.0,))
    own = retry_wait(attempt, F.lit(None).cast("string"), now, waits) + F.coalesce(jitter, F.lit(0.0))
    return F.struct(F.when(asked >= 0, asked).otherwise(own).alias("wait"), (asked > pause).alias("pause"))


def worker_limit(requested: Column, memory_mb: Column, file_bytes: Column, each_mb: int = 512) -> Column:
    """How many workers of ``each_mb`` and the file's size fit into the memory: 1 to ``requested``."""
    need = F.lit(each_mb) + F.ceil(F.coalesce(file_bytes, F.lit(0)) / (1 << 20))
    return F.greatest(F.lit(1), F.least(requested, F.floor(memory_mb / need))).cast("int")
