"""Timestamps of many forms, precisions and zones as one unambiguous UTC form.

All forms are compiled into one alternation with named groups; each text is matched once.
The numbers of a batch are then checked and turned into instants as whole columns: days from
the civil calendar, seconds and microseconds as integers, zone offsets from tables of each
zone's transitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Bahia"

# Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {"BRT": -180, "BRST": -120, "WET": 0, "WEST": 60, "EST": -300, "EDT": -240, "UTC": 0, "GMT": 0, "UT": 0, "Z": 0}

# Names of months, Portuguese and English, by their first three letters.
MONTHS = {
    "jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6, "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12,
    "feb": 2, "apr": 4, "may": 5, "aug": 8, "sep": 9, "oct": 10, "dec": 12,
}
MONTH_NAMES = "janeiro fevereiro março marco abril maio junho julho agosto setembro outubro novembro dezembro".split()
ENGLISH_MONTHS = "january february march april may june july august september october november december".split()

PARTS = {
    "Y": r"(?P<Y_>\d{4})", "y": r"(?P<y_>\d{2})", "M": r"(?P<M_>\d{1,2})", "MM": r"(?P<M_>\d{2})", "D": r"(?P<D_>\d{1,2})", "DD": r"(?P<D_>\d{2})",
    "h": r"(?P<h_>\d{1,2})", "hh": r"(?P<h_>\d{2})", "m": r"(?P<m_>\d{2})", "s": r"(?P<s_>\d{2})", "f": r"(?:[.,](?P<f_>\d{1,30}))?",
    "NAME": r"(?P<N_>" + "|".join(sorted({*MONTH_NAMES, *ENGLISH_MONTHS, *MONTHS}, key=len, reverse=True)) + r")\.?",
    "OFF": r"(?P<o_>[+-]\d{2}(?::?\d{2})?)", "ABBR": r"(?P<a_>" + "|".join(sorted(ABBREVIATIONS, key=len, reverse=True)) + r")", "IANA": r"(?P<z_>[A-Za-z][A-Za-z0-9_+-]*(?:/[A-Za-z0-9_+-]+)+|UTC|GMT)",
    "ZONE": r"(?:\s?(?:{OFF}|{ABBR}))?(?:\s?\[{IANA}\]|\s{IANA2})?",
}

#: Every form, as literal text and names of PARTS in braces. A time of day is optional where marked.
FORMS = [
    r"{Y}-{MM}-{DD}(?:[T ]{hh}:{m}(?::{s}{f})?{ZONE})?",
    r"{Y}/{MM}/{DD}(?:[T ]{hh}:{m}(?::{s}{f})?{ZONE})?",
    r"{D}[/.]{M}[/.]{Y}(?:,?\s+{h}[:h]{m}(?::{s}{f})?{ZONE})?",
    r"{D}[/.]{M}[/.]{y}(?:,?\s+{h}[:h]{m}(?::{s}{f})?{ZONE})?",
    r"{D}-{M}-{Y}(?:\s+{h}[:h]{m}(?::{s}{f})?{ZONE})?",
    r"{D}-{M}-{y}(?:\s+{h}[:h]{m}(?::{s}{f})?{ZONE})?",
    r"(?:[A-Za-z]{{3}},\s+)?{D}\s+{NAME}\s+{Y}(?:\s+{hh}:{m}(?::{s}{f})?{ZONE})?",
    r"{D}º?\s+de\s+{NAME}\s+de\s+{Y}(?:,?\s+(?:[àa]s\s+)?{h}[:h]{m}(?::{s}{f})?(?:\s*h(?:oras)?)?{ZONE})?",
    r"{Y}{MM}{DD}{hh}{m}{s}",
    r"{Y}{MM}{DD}",
    r"(?P<E_>-?\d{{10}}|\d{{13}})",
    r"{Y}{MM}{DD}T{hh}{m}{s}{f}{ZONE}",
]


def _compile(forms: Iterable[str]) -> re.Pattern[str]:
    out = []
    for k, form in enumerate(forms):
        parts = {n: p for n, p in PARTS.items()}
        parts["ZONE"] = parts["ZONE"].format(OFF=parts["OFF"], ABBR=parts["ABBR"], IANA=parts["IANA"], IANA2=parts["IANA"].replace("z_", "w_"))
        text = form.format(**parts)
        out.append(f"(?P<form_{k}>" + re.sub(r"\(\?P<(\w)_>", rf"(?P<\g<1>_{k}>", text) + ")")
    return re.compile("|".join(out).replace(r"\d", "[0-9]"), re.IGNORECASE)


PATTERN = _compile(FORMS)
GROUPS = [{g[0]: i for g, i in PATTERN.groupindex.items() if g[1:] == f"_{k}"} for k in range(len(FORMS))]
CANONICAL = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{6})?Z")
CANONICAL_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


def civil_days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of the proleptic Gregorian calendar."""
    y = np.where(m <= 2, y - 1, y)
    era = y // 400
    of_era = y - era * 400
    of_year = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + of_era * 365 + of_era // 4 - of_era // 100 + of_year - 719468


def civil_date(days: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of ``civil_days``."""
    z = days + 719468
    era = z // 146097
    doe = z - era * 146097
    yoe = (doe - doe // 1460 + doe // 36524 - doe // 146096) // 365
    doy = doe - (365 * yoe + yoe // 4 - yoe // 100)
    mp = (5 * doy + 2) // 153
    m = np.where(mp < 10, mp + 3, mp - 9)
    return yoe + era * 400 + (m <= 2), m, doy - (153 * mp + 2) // 5 + 1


@lru_cache(maxsize=None)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """UTC seconds from which each offset of ``zone`` holds, and the offsets; None if the zone is unknown."""
    try:
        info = ZoneInfo(zone)
    except (KeyError, ValueError, OSError):
        return None

    def offset(t: int) -> int:
        return int(datetime.fromtimestamp(t, UTC).astimezone(info).utcoffset().total_seconds())

    start, stop, step = -2_208_988_800, 4_102_444_800, 14 * 86_400  # 1900 to 2100
    at, offsets, last = [-(1 << 62)], [offset(start)], start
    for t in range(start + step, stop, step):
        if (o := offset(t)) != offsets[-1]:
            low, high = last, t
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if offset(mid) == offsets[-1] else (low, mid)
            at.append(high)
            offsets.append(o)
        last = t
    return np.array(at, np.int64), np.array(offsets, np.int64)


def offset_at(zone: str, utc: np.ndarray) -> np.ndarray:
    at, offsets = transitions(zone)
    return offsets[np.searchsorted(at, utc, side="right") - 1]


def local_to_utc(zone: str, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of wall-clock seconds, and whether that wall-clock time exists. A time that
    occurs twice, when clocks go back, means its first occurrence."""
    before, after = offset_at(zone, local - 86_400), offset_at(zone, local + 86_400)
    a, b = local - before, local - after
    a_ok, b_ok = offset_at(zone, a) == before, offset_at(zone, b) == after
    return np.where(a_ok, a, b), a_ok | b_ok


def parse(texts: list[str | None], zone: str = DEFAULT_ZONE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(UTC seconds, microseconds, known, day) of each text; day comes before month, a text without
    zone is wall-clock time of ``zone``, two-digit years are 1969 to 2068, digits past
    microseconds are cut, missing parts are 0. Texts that state no existing moment, also null
    and empty ones, are not known. The last array has the day number written in texts without
    time of day, else a large negative number; such a day is known even if clocks skip its midnight."""
    n = len(texts)
    num = np.zeros((7, n), np.int64)  # Y M D h m s us
    num[1:3] = 1
    known = np.zeros(n, bool)
    epoch = np.zeros(n, bool)
    shift = np.full(n, -1 << 40, np.int64)  # minutes, if the text has an offset
    bare = np.zeros(n, bool)
    zones: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if not text or not (m := PATTERN.fullmatch(text.strip())):
            continue
        g = GROUPS[int(m.lastgroup[5:])]
        get = lambda k, m=m, g=g: m.group(g[k]) if k in g else None
        known[i] = True
        if digits := get("E"):
            whole = int(digits)
            ms = len(digits) == 13
            num[5, i], num[6, i] = (whole // 1000, whole % 1000 * 1000) if ms else (whole, 0)
            epoch[i] = True
            continue
        if year := get("Y"):
            num[0, i] = int(year)
        else:
            short = int(get("y"))
            num[0, i] = short + (1900 if short >= 69 else 2000)
        name = get("N")
        num[1, i] = MONTHS[name[:3].lower()] if name else int(get("M"))
        num[2, i] = int(get("D"))
        for row, k in ((3, "h"), (4, "m"), (5, "s")):
            if v := get(k):
                num[row, i] = int(v)
        bare[i] = not get("h")
        if f := get("f"):
            num[6, i] = int(f[:6].ljust(6, "0"))
        if o := get("o"):
            h, minutes = int(o[1:3]), int(o[3:].lstrip(":") or 0)
            known[i] = h <= 18 and minutes < 60
            shift[i] = (h * 60 + minutes) * (-1 if o[0] == "-" else 1)
        elif a := get("a"):
            shift[i] = ABBREVIATIONS[a.upper()]
        else:
            zones.setdefault(get("z") or get("w") or zone, []).append(i)
    y, mo, d, h, mi, s, us = num
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    month_ok = (mo >= 1) & (mo <= 12)
    length = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.where(month_ok, mo, 0)] + ((mo == 2) & leap)
    in_range = month_ok & (d >= 1) & (d <= length) & (h <= 23) & (mi <= 59) & (s <= 59) & (y >= 1)
    known &= in_range | epoch
    seconds = np.where(epoch, s, civil_days(y, np.where(month_ok, mo, 1), d) * 86_400 + h * 3600 + mi * 60 + s)
    day = np.where(bare & known, seconds // 86_400, -1 << 40)
    has_shift = shift > -1 << 40
    seconds = np.where(has_shift, seconds - shift * 60, seconds)
    for name, rows in zones.items():
        at = np.array(rows)
        if transitions(name) is None:
            known[at] = False
            continue
        seconds[at], exists = local_to_utc(name, seconds[at])
        known[at] &= exists | bare[at]
    # four-digit years only
    known &= (seconds >= -62_135_596_800) & (seconds < 253_402_300_800)
    return seconds, us, known, day


def to_utc_text(texts: list[str | None], zone: str = DEFAULT_ZONE) -> list[str | None]:
    seconds, us, known, _ = parse(texts, zone)
    y, m, d = civil_date(seconds // 86_400)
    rest = seconds % 86_400
    return [
        f"{a:04d}-{b:02d}-{c:02d}T{r // 3600:02d}:{r // 60 % 60:02d}:{r % 60:02d}.{u:06d}Z" if k else None
        for a, b, c, r, u, k in zip(y.tolist(), m.tolist(), d.tolist(), rest.tolist(), us.tolist(), known.tolist())
    ]


def to_local_date(texts: list[str | None], zone: str = DEFAULT_ZONE) -> list[str | None]:
    seconds, _, known, day = parse(texts, zone)
    seconds = np.where(known, seconds, 0)
    y, m, d = civil_date(np.where(day > -1 << 40, day, (seconds + offset_at(zone, seconds)) // 86_400))
    return [f"{a:04d}-{b:02d}-{c:02d}" if k else None for a, b, c, k in zip(y.tolist(), m.tolist(), d.tolist(), known.tolist())]


def _texts(values: pd.Series) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in values]


def utc_moment(value: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` of a text column; null where it states no moment."""

    @F.pandas_udf("string")
    def moment(values: pd.Series) -> pd.Series:
        return pd.Series(to_utc_text(_texts(values), zone), dtype=object)

    return moment(value)


def local_date(value: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """``YYYY-MM-DD`` in ``zone`` of a text column; null where it states no moment. A date
    without time of day is taken as it is."""

    @F.pandas_udf("string")
    def date(values: pd.Series) -> pd.Series:
        return pd.Series(to_local_date(_texts(values), zone), dtype=object)

    return date(value)


def normalised(values: DataFrame, value: str, dated: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """``values`` with ``value_out`` and ``canonical``. Where the boolean column ``dated`` holds the
    text is a date, out comes ``YYYY-MM-DD`` in ``zone``; else a moment, out comes UTC. Each text
    is read once. A null text, and one that states no existing moment, has null value_out;
    canonical is false for null. Columns of these names are replaced."""
    kept = values.drop("value_out", "canonical")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(value)).to_pylist()
            is_date = [bool(d) for d in batch.column(names.index(dated)).to_pylist()]
            out: list[str | None] = [None] * len(texts)
            for kind, read in ((True, to_local_date), (False, to_utc_text)):
                at = [i for i, d in enumerate(is_date) if d == kind]
                for i, v in zip(at, read([texts[i] for i in at], zone)):
                    out[i] = v
            forms = [bool(t and (CANONICAL_DATE if d else CANONICAL).fullmatch(t)) for t, d in zip(texts, is_date)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string()), pa.array(forms, pa.bool_())], names=[*names, "value_out", "canonical"])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInArrow(run, ", ".join([*schema, "value_out string", "canonical boolean"]))


def is_canonical(value: Column, date: bool = False) -> Column:
    return value.rlike("^" + (CANONICAL_DATE if date else CANONICAL).pattern + r"\z")
