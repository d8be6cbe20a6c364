"""Structural index of JSON lines.

Many lines are read at once as one byte array. Masks of quotes and backslashes with prefix
parity tell bytes inside strings from those outside; the brackets, commas, colons, strings
and scalars outside are the tokens. Sorting the tokens by nesting level puts the members of
each container side by side, so the grammar is a check of neighbours and no line is walked
byte by byte in Python.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

SCALAR = re.compile(rb"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null")
INTEGER = re.compile(rb"-?(?:0|[1-9][0-9]*)")

OPEN, CLOSE, COMMA, COLON, TEXT, VALUE = range(6)

_KIND = np.full(256, 255, np.uint8)
_KIND[[123, 91]] = OPEN
_KIND[[125, 93]] = CLOSE
_KIND[44] = COMMA
_KIND[58] = COLON
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_ESCAPE = np.zeros(256, bool)
_ESCAPE[list(b'"\\/bfnrtu')] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True


@dataclass
class Index:
    """What the index knows of each line; ``fields`` holds the asked top-level values as
    JSON text (bytes), ``None`` where the field is absent."""

    broken: np.ndarray
    duplicate: np.ndarray
    is_object: np.ndarray
    field_hash: np.ndarray
    field_count: np.ndarray
    fields: dict[str, list[bytes | None]] = field(default_factory=dict)


#: Bytes of text that are indexed at once: bounds the memory of masks and tokens.
SLICE = 1 << 20


def slices(sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of lines of these ``sizes`` of about ``most`` bytes; a longer line is a run of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = before = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start, before = stop, int(ends[stop - 1])


def strings(values: Iterable[str | None]) -> pa.Array:
    """``values`` as an Arrow column. Half of a surrogate pair, which JSON text may state but no
    Unicode text holds, is kept as its escape."""
    values = list(values)
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([v if v is None else v.encode("utf-8", "backslashreplace").decode() for v in values], pa.string())


def key_hash(name: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True)


def index_lines(lines: list[bytes], wanted: tuple[str, ...] = ()) -> Index:
    """Index ``lines`` and judge each as strict JSON.

    ``broken``: not exactly one JSON value (blank, bare NaN or Infinity, control characters in
    strings, bad escapes and numbers all count). ``duplicate``: some object repeats a key,
    compared after decoding escapes. Lines that are broken have no meaning in other arrays.
    """
    n = len(lines)
    # a newline closes each line; it is white space, so it changes no judgement
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    lengths = np.fromiter((len(x) + 1 for x in lines), np.int64, n)
    ends = np.cumsum(lengths)
    broken = np.zeros(n, bool)
    out = Index(broken, np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int32), {w: [None] * n for w in wanted})
    if not n:
        return out
    size = len(data)

    def line_at(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, places, side="right")

    # --- quote mask and prefix parity; masks have one byte a character, all else is sparse
    quotes = np.flatnonzero(data == 34)
    slashes = np.flatnonzero(data == 92)
    if len(slashes):
        place = np.arange(len(slashes))
        first_of_run = np.ones(len(slashes), bool)
        first_of_run[1:] = slashes[1:] != slashes[:-1] + 1
        nth = place - np.maximum.accumulate(np.where(first_of_run, place, 0))
        # backslashes that begin an escape: those at an even distance into their run
        begins = slashes[(nth & 1) == 0]
        # a quote after such a backslash is escaped
        quotes = quotes[~np.isin(quotes - 1, begins, assume_unique=True)]
    else:
        begins = slashes
    quotes_to = np.searchsorted(quotes, ends)
    open_at_end = np.diff(quotes_to, prepend=0) & 1 == 1
    broken |= open_at_end
    mark = np.zeros(size, np.uint8)
    mark[quotes] = 1
    # a string that its line leaves open ends with the line
    mark[ends[open_at_end] - 1] ^= 1
    parity = np.add.accumulate(mark, dtype=np.uint8)
    parity &= 1
    inside = (parity | mark).view(bool)  # with both quotes

    # --- inside strings: control characters and escapes
    broken[line_at(np.flatnonzero(inside & (data < 32)))] = True
    if len(begins):
        within = inside[begins]
        broken[line_at(begins[~within])] = True
        begins = begins[within]
        after = data[np.minimum(begins + 1, size - 1)]
        broken[line_at(begins[~_ESCAPE[after]])] = True
        unicode_at = begins[after == 117]
        for k in range(2, 6):
            broken[line_at(unicode_at[~_HEX[data[np.minimum(unicode_at + k, size - 1)]]])] = True

    # --- tokens outside strings
    kind_at = _KIND[data]
    is_token = kind_at != 255
    is_token &= ~inside
    scalar = ~(inside | is_token | _SPACE[data])
    scalar_start = scalar.copy()
    scalar_start[1:] &= ~scalar[:-1]
    scalar_ends = np.flatnonzero(scalar[:-1] & ~scalar[1:]) + 1  # the last character is a newline
    opening = quotes[parity[quotes] == 1]
    closing = quotes[parity[quotes] == 0]
    is_token |= scalar_start
    is_token[opening] = True
    pos = np.flatnonzero(is_token)
    line = line_at(pos)
    kind = kind_at[pos].copy()
    kind[data[pos] == 34] = TEXT
    kind[scalar_start[pos]] = VALUE
    # end (exclusive) of strings and scalars
    end = pos + 1
    texts = np.flatnonzero(kind == TEXT)
    if len(opening):
        nearest = np.searchsorted(closing, pos[texts])
        has = nearest < len(closing)
        end[texts[has]] = closing[nearest[has]] + 1
    scalars = np.flatnonzero(kind == VALUE)
    end[scalars] = scalar_ends
    del mark, parity, inside, is_token, scalar, scalar_start, scalar_ends
    blob = data.tobytes()
    good: dict[bytes, bool] = {}
    for t, a, b in zip(scalars.tolist(), pos[scalars].tolist(), end[scalars].tolist()):
        s = blob[a:b]
        ok = good.get(s)
        if ok is None:
            ok = good[s] = SCALAR.fullmatch(s) is not None
        if not ok:
            broken[line[t]] = True

    # --- levels: an opening bracket belongs to its own level and, as a value, to its parent's
    step = np.where(kind == OPEN, 1, np.where(kind == CLOSE, -1, 0))
    depth = np.cumsum(step)
    first = np.searchsorted(line, np.arange(n))
    last = np.searchsorted(line, np.arange(n), side="right")
    empty = first == last
    broken |= empty
    depth_base = np.where(first > 0, depth[np.maximum(first - 1, 0)], 0) if len(pos) else np.zeros(n, np.int64)
    depth = depth - depth_base[line]
    broken[line[depth < 0]] = True
    broken |= ~empty & (depth[np.maximum(last - 1, 0)] != 0) if len(pos) else True
    level = np.where(kind == CLOSE, depth + 1, depth)
    keep = ~broken[line]
    index = np.flatnonzero(keep)
    opens = index[kind[index] == OPEN]
    token = np.concatenate([index, opens])
    lev = np.concatenate([level[index], level[opens] - 1])
    cls = np.concatenate([kind[index], np.full(len(opens), VALUE, np.uint8)])
    tok_line = line[token]
    # one key: lines and levels fit into it, and tokens are in order before the openings are added
    order = np.argsort((tok_line.astype(np.int64) * (int(lev.max(initial=0)) + 2) + lev + 1) * (len(pos) + 1) + token)
    token, lev, cls, tok_line = token[order], lev[order], cls[order], tok_line[order]
    if not len(token):
        out.broken = broken
        return out

    run_start = np.ones(len(token), bool)  # a new line or level begins
    run_start[1:] = (tok_line[1:] != tok_line[:-1]) | (lev[1:] != lev[:-1])
    # top level: exactly one value
    top = lev == 0
    values_at_top = np.bincount(tok_line[top], minlength=n)
    broken[tok_line[top & ~((cls == VALUE) | (cls == TEXT))]] = True
    broken |= values_at_top != 1
    # deeper: container = the opening bracket before
    opener = (cls == OPEN) & ~top
    broken[tok_line[~top & run_start & ~opener]] = True
    container = np.maximum.accumulate(np.where(opener, np.arange(len(token)), 0))
    byte = data[pos[token]]
    in_object = byte[container] == 123
    prev = np.empty(len(token), np.uint8)
    prev[0] = 255
    prev[1:] = cls[:-1]
    after_open = (prev == OPEN) | (prev == COMMA)
    is_value = (cls == VALUE) | (cls == TEXT)
    prev_value = (prev == VALUE) | (prev == TEXT)
    is_key = ~top & in_object & (cls == TEXT) & after_open & ~run_start
    prev_key = np.zeros(len(token), bool)
    prev_key[1:] = is_key[:-1]
    in_obj_ok = (
        is_key
        | ((cls == COLON) & prev_key)
        | (is_value & (prev == COLON))
        | ((cls == COMMA) & prev_value & ~prev_key)
        | ((cls == CLOSE) & ((prev == OPEN) | (prev_value & ~prev_key)))
    )
    in_arr_ok = (is_value & after_open) | ((cls == COMMA) & prev_value) | ((cls == CLOSE) & ((prev == OPEN) | prev_value))
    ok = np.where(in_object, in_obj_ok, in_arr_ok)
    # what opens after a run began must follow a closing bracket
    ok = np.where(opener, run_start | (prev == CLOSE), ok)
    # brackets of one container are of one kind ({ } differ by 2, [ ] by 2)
    ok &= (cls != CLOSE) | (byte == byte[container] + 2)
    broken[tok_line[~top & ~ok]] = True

    # --- keys
    keys = np.flatnonzero(is_key & ~broken[tok_line])
    names: dict[bytes, int] = {}
    hashes: list[int] = []
    decoded: list[bytes] = []
    found_codes: list[int] = []
    from_, to = pos[token[keys]] + 1, end[token[keys]] - 1
    for a, b in zip(from_.tolist(), to.tolist()):
        raw = blob[a:b]
        code = names.get(raw)
        if code is None:
            name = raw if b"\\" not in raw else json.loads(b'"' + raw + b'"').encode("utf-8", "surrogatepass")
            code = names.get(name) if name is not raw else None
            if code is None:
                code = len(hashes)
                hashes.append(key_hash(name))
                decoded.append(name)
                names[name] = code
            names[raw] = code
        found_codes.append(code)
    codes = np.array(found_codes, np.int64)
    # a decoded name may have been met before in its plain form: unify by name
    if hashes:
        unify: dict[bytes, int] = {}
        same = np.array([unify.setdefault(x, i) for i, x in enumerate(decoded)])
        codes = same[codes]
        pair = container[keys] * np.int64(len(hashes)) + codes
        sort = np.argsort(pair, kind="stable")
        twice = np.flatnonzero(pair[sort][1:] == pair[sort][:-1])
        out.duplicate[tok_line[keys[sort[twice + 1]]]] = True
        top_keys = lev[keys] == 1
        key_line = tok_line[keys[top_keys]]
        np.add.at(out.field_hash, key_line, np.array(hashes, np.int64)[codes[top_keys]])
        np.add.at(out.field_count, key_line, 1)
        for want in wanted:
            code = unify.get(want.encode())
            if code is None:
                continue
            for k in keys[top_keys & (codes == code)]:
                v = token[k + 2]  # key, colon, value are neighbours at this level
                out.fields[want][tok_line[k]] = blob[pos[v]:end[v]]
    root = np.flatnonzero(top & (byte == 123))
    out.is_object[tok_line[root]] = True
    out.broken = broken
    return out
