"""Layouts that drift between the files of a feed, and one table over all of them.

Each batch of records is reduced to counts of (file, path, JSON type) where it is read; the
counts of a file are its header schema. Files are then compared with their predecessor pair
by pair. Whether a field that vanished goes on under another name is told by its content: the
values of the cases both files hold, or without such cases the forms of the values.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resma.operators.structural import key_hash, strings
from resma.plans.cut import cut
from resma.plans.lookup import lookup

JSON_TYPES = ("boolean", "integer", "number", "string", "array", "object")
NULL = "null"

#: Least share of equal values (or of like forms) at which a field counts as carried on.
RENAME_SHARE = 0.6


def json_type(value: object) -> str:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, float):
        return "number"
    if isinstance(value, str):
        return "string"
    return "array" if isinstance(value, list) else "object"


def record_paths(value: object, path: str, out: set[tuple[str, str]]) -> None:
    """Adds each (path, type) that ``value`` shows at and below ``path``."""
    stack = [(value, path)]
    while stack:
        value, path = stack.pop()
        if path:
            out.add((path, json_type(value)))
        if isinstance(value, dict):
            stack.extend((v, f"{path}.{k}" if path else k) for k, v in value.items())
        elif isinstance(value, list):
            stack.extend((v, path + "[]") for v in value)


def parent_path(path: str) -> str:
    if path.endswith("[]"):
        return path[:-2]
    return path.rpartition(".")[0]


def values_at(record: object, path: str) -> list[object]:
    """The values of ``record`` at ``path``, nulls left out."""
    level = [record]
    for name in path.split("."):
        lists = 0
        while name.endswith("[]"):
            name, lists = name[:-2], lists + 1
        level = [x[name] for x in level if isinstance(x, dict) and name in x]
        for _ in range(lists):
            level = [y for x in level if isinstance(x, list) for y in x]
    return [x for x in level if x is not None]


def form_of(value: object) -> str:
    """What a value looks like: digits and words made alike, objects by their members."""
    if isinstance(value, dict):
        return "{" + ",".join(sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(sorted({form_of(x) for x in value})) + "]"
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", lambda m: "9" * len(m.group()), str(value)))


#: Marks (name, type) pairs of top-level names, exact whatever characters a name holds.
TOP = "\x00"
#: Integers up to here are exact as double, and up to the second as 64-bit integers.
EXACT, LONG = 1 << 53, 1 << 63


def column_type(value: object) -> str:
    """The type of a top-level value in the lattice of ``promote``."""
    kind = json_type(value)
    if kind == "integer" and abs(value) > EXACT:
        return "long" if -LONG <= value < LONG else "huge"
    return kind


def record_types(record: object) -> set[tuple[str, str]]:
    """(path, type) of all that a record holds, and (TOP + name, column type) of its top-level names."""
    seen: set[tuple[str, str]] = set()
    if isinstance(record, dict):
        record_paths(record, "", seen)
        seen.update((TOP + k, column_type(v)) for k, v in record.items())
    return seen


def header_counts(records: DataFrame, file: str, raw: str) -> DataFrame:
    """(file, path, type, n): the number of records of each file that show the type at the path,
    as ``record_types`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, str, str]] = Counter()
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((name, p, t) for p, t in record_types(json.loads(text)))
            rows = list(counts.items())
            yield pa.RecordBatch.from_arrays(
                [strings(k[i] for k, _ in rows) for i in range(3)] + [pa.array([n for _, n in rows], pa.int64())],
                names=["file", "path", "type", "n"],
            )

    found = records.select(file, raw).where(F.col(raw).isNotNull()).mapInArrow(run, "file string, path string, type string, n long")
    return found.groupBy("file", "path", "type").agg(F.sum("n").alias("n"))


def file_schemas(counts: DataFrame) -> DataFrame:
    """(file, path, type): the type most records of the file show there, ``null`` if none but
    null is shown; of equally common types the one that holds the other (see ``JSON_TYPES``)."""
    rank = F.create_map(*[x for i, t in enumerate(JSON_TYPES) for x in (F.lit(t), F.lit(i))])
    best = F.max(F.when(F.col("type") != NULL, F.struct(F.col("n"), rank[F.col("type")].alias("r"), F.col("type"))))
    return counts.where(~F.col("path").startswith(TOP)).groupBy("file", "path").agg(F.coalesce(best["type"], F.lit(NULL)).alias("type"))


def standing(schema: dict[str, str]) -> dict[str, str]:
    """The paths of ``schema`` that do not lie below a path whose type has no such part."""
    out: dict[str, str] = {}
    for path in sorted(schema, key=len):
        parent = parent_path(path)
        if not parent or (parent in out and out[parent] == ("array" if path.endswith("[]") else "object")):
            out[path] = schema[path]
    return out


def schema_changes(old: dict[str, str], new: dict[str, str]) -> list[tuple[str, str, str, str]]:
    """(drift, old path, new path, type): added, removed and type_changed; nothing is told
    below a path that is told itself."""
    old, new = standing(old), standing(new)
    told: dict[str, tuple[str, str, str, str]] = {}
    for path in old.keys() | new.keys():
        if path not in old:
            told[path] = ("added", "", path, new[path])
        elif path not in new:
            told[path] = ("removed", path, "", old[path])
        elif old[path] != new[path] and NULL not in (old[path], new[path]):
            told[path] = ("type_changed", path, path, new[path])

    def covered(path: str) -> bool:
        while path := parent_path(path):
            if path in told:
                return True
        return False

    return [told[p] for p in sorted(told) if not covered(p)]


def file_changes(schemas: DataFrame, order: DataFrame) -> DataFrame:
    """(file, before, drift, old_field, new_field, type): each file of ``order`` (file, before)
    against the file before it; a rename still counts as removed and added."""
    ordered = order.where(F.col("before").isNotNull()).select("file", "before")
    # one row a file: the paths of its layout, never its records
    held = cut(schemas.groupBy("file").agg(F.collect_list("path").alias("paths"), F.collect_list("type").alias("types")))
    of = lambda f, n: held.select(F.col("file").alias(f), F.col("paths").alias(f"paths{n}"), F.col("types").alias(f"types{n}"))
    pairs = ordered.join(of("before", 0), "before").join(of("file", 1), "file").select("file", "before", "paths0", "types0", "paths1", "types1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for file, before, p0, t0, p1, t1 in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(file, before, *c) for c in schema_changes(dict(zip(p0, t0)), dict(zip(p1, t1)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*out)) or [[]] * 6], names=["file", "before", "drift", "old_field", "new_field", "type"])

    return pairs.mapInArrow(run, "file string, before string, drift string, old_field string, new_field string, type string")


def rename_candidates(changes: DataFrame) -> DataFrame:
    """(file, before, old_field, new_field) of one type, one vanished and one new in the same file."""
    gone = changes.where((F.col("drift") == "removed") & (F.col("type") != NULL)).select("file", "before", "type", "old_field")
    come = changes.where((F.col("drift") == "added") & (F.col("type") != NULL)).select("file", "type", "new_field")
    return gone.join(come, ["file", "type"])


def field_content(records: DataFrame, candidates: DataFrame, file: str, raw: str, case: str) -> DataFrame:
    """(pair, old_field, new_field, kind, key, v0, v1, n0, n1): what the files of each candidate hold.

    kind ``case``: the hash of the old value (v0) and the new one (v1) of the case ``key``. kind
    ``form``: how many values of the old (n0) and new (n1) field have the form ``key``; forms are
    counted where the records are read. One shuffle of partial aggregates.
    """
    side = lambda f, path, old: candidates.select(F.col(f).alias("file"), F.struct(F.col("file").alias("pair"), "old_field", "new_field", F.col(path).alias("path"), F.lit(old).alias("old")).alias("c"))
    wanted = side("before", "old_field", True).unionByName(side("file", "new_field", False)).groupBy("file").agg(F.collect_list("c").alias("_asked"))
    rows = lookup(records.select(F.col(file).alias("file"), raw), wanted, "file", how="inner").select("_asked", raw)
    schema = "pair string, old_field string, new_field string, kind string, key long, v0 long, v1 long, n0 long, n1 long"
    kinds = (*[pa.string()] * 4, *[pa.int64()] * 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cases: list[tuple] = []
            forms: Counter[tuple] = Counter()
            for asked, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record = json.loads(text)
                entity = key_hash(str(record.get(case)).encode("utf-8", "surrogatepass")) if isinstance(record, dict) else 0
                read: dict[str, tuple[int, int] | None] = {}
                for a in asked:
                    path = a["path"]
                    if path not in read:
                        found = values_at(record, path)
                        value = json.dumps(found, sort_keys=True).encode()
                        form = "|".join(map(form_of, found)).encode("utf-8", "surrogatepass")
                        # a short form tells nothing: the value itself stands for it
                        read[path] = (key_hash(value), key_hash(form if len(form) >= 4 else value)) if found else None
                    if (seen := read[path]) is None:
                        continue
                    name = (a["pair"], a["old_field"], a["new_field"])
                    cases.append((*name, "case", entity, seen[0] if a["old"] else None, None if a["old"] else seen[0], 0, 0))
                    forms[(*name, seen[1], a["old"])] += 1
            cases += [(*k[:3], "form", k[3], None, None, n if k[4] else 0, 0 if k[4] else n) for k, n in forms.items()]
            cols = list(zip(*cases)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([strings(c) if t == pa.string() else pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema).groupBy("pair", "old_field", "new_field", "kind", "key").agg(*[F.min(v).alias(v) for v in ("v0", "v1")], *[F.sum(n).alias(n) for n in ("n0", "n1")])


def scored_renames(records: DataFrame, candidates: DataFrame, file: str, raw: str, case: str) -> DataFrame:
    """``candidates`` with ``score``: the share of equal values over the cases both files hold
    if there are three or more, else the overlap of the forms of all values (averaged with the
    share of equal values if there is a shared case)."""
    candidates = cut(candidates)
    keys = ["pair", "old_field", "new_field"]
    content = cut(field_content(records, candidates, file, raw, case))
    both = F.col("v0").isNotNull() & F.col("v1").isNotNull()
    sums = cut(content.groupBy(*keys).agg(F.count_if(both).alias("shared"), F.count_if(both & (F.col("v0") == F.col("v1"))).alias("same"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1")))
    # a form on one side only adds nothing to the overlap
    met = content.where((F.col("kind") == "form") & (F.col("n0") > 0) & (F.col("n1") > 0))
    overlap = met.join(sums, keys).groupBy(*keys).agg(F.sum(F.least(F.col("n0") / F.col("t0"), F.col("n1") / F.col("t1"))).alias("alike"))
    scored = candidates.withColumnRenamed("file", "pair").join(sums, keys, "left").join(overlap, keys, "left")
    alike = F.coalesce("alike", F.lit(0.0))
    equal = F.col("same") / F.col("shared")
    score = F.when(F.col("shared") >= 3, equal + alike / 1000).when(F.col("shared") >= 1, (equal + alike) / 2).otherwise(alike)
    return scored.select("pair", "before", "type", "old_field", "new_field", score.alias("score"))


def best_renames(scored: DataFrame, least: float = RENAME_SHARE) -> DataFrame:
    """The candidates of at least ``least`` that are the best of both their fields; ties go to
    the first names."""
    last = [F.desc("score"), "old_field", "new_field"]
    ranked = scored.where(F.col("score") >= least)
    for side in ("old_field", "new_field"):
        ranked = ranked.withColumn(f"_{side}", F.row_number().over(Window.partitionBy("pair", side).orderBy(*last)))
    return ranked.where((F.col("_old_field") == 1) & (F.col("_new_field") == 1)).select(F.col("pair").alias("file"), "old_field", "new_field")


def with_renames(changes: DataFrame, renames: DataFrame) -> DataFrame:
    """(file, drift, old_field, new_field): ``changes`` in which each rename takes the place of
    a removed and an added field."""
    gone = renames.select("file", "old_field", F.lit("removed").alias("drift"), F.lit(True).alias("_gone"))
    come = renames.select("file", "new_field", F.lit("added").alias("drift"), F.lit(True).alias("_come"))
    rest = changes.join(gone, ["file", "old_field", "drift"], "left").join(come, ["file", "new_field", "drift"], "left")
    rest = rest.where(F.col("_gone").isNull() & F.col("_come").isNull()).select("file", "drift", "old_field", "new_field")
    return rest.unionByName(renames.select("file", F.lit("renamed").alias("drift"), "old_field", "new_field"))


def file_order(files: DataFrame, file: str = "dataset_id", path: str = "input_path") -> DataFrame:
    """(file, before, feed): the folder of ``path`` is the feed, the file names its order."""
    feed = F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    keyed = files.select(F.col(file).alias("file"), feed.alias("feed"), F.regexp_extract(path, "([^/]*)$", 1).alias("_name"))
    return keyed.withColumn("before", F.lag("file").over(Window.partitionBy("feed").orderBy("_name", "file"))).drop("_name")


def record_drift(records: DataFrame, order: DataFrame, file: str = "dataset_id", raw: str = "raw_json", case: str = "process_number", counts: DataFrame | None = None) -> DataFrame:
    """Every change of the records' layout (file, drift, old_field, new_field) at the file
    where it happens. ``records`` must load. A file without records has no layout: it is told
    nothing of, nor is the file after it. A null text is no record. ``counts``: the header
    counts of the records, if an earlier pass has made them."""
    if counts is None:
        counts = header_counts(records, file, raw)
    changes = cut(file_changes(file_schemas(counts), order))
    scored = scored_renames(records, rename_candidates(changes), file, raw, case)
    return with_renames(changes, best_renames(scored))


# --- one value a file: sidecars


def carried_on(old: object, new: object, old_size: int, new_size: int) -> float:
    """How well a sidecar's new value could go on for the old one (0 to 1). Counts are compared
    by their ratio to the file's number of records."""
    if old == new:
        return 1.0
    if isinstance(old, dict):
        return len(old.keys() & new.keys()) / max(1, len(old.keys() | new.keys()))
    if isinstance(old, bool):
        return RENAME_SHARE
    if isinstance(old, (int, float)):
        # a count follows the file's size; another measure stays within a decade
        if isinstance(old, int) and max(abs(old), abs(new)) > 9:
            a, b = old / max(1, old_size), new / max(1, new_size)
            if max(a, b) > 0 and min(a, b) / max(a, b) > 0.7:
                return 0.9
            return 0.0
        low, high = sorted((abs(old), abs(new)))
        return RENAME_SHARE if high <= 10 * max(low, 1e-9) else 0.0
    if isinstance(old, str):
        if form_of(old) == form_of(new):
            return 0.95
        a, b = set(old.lower().split()), set(new.lower().split())
        return len(a & b) / max(1, len(a | b))
    return 0.95 if form_of(old) == form_of(new) else 0.0


def sidecar_drift(files: DataFrame, order: DataFrame, file: str = "dataset_id", metadata: str = "metadata_json", size: str = "record_count") -> DataFrame:
    """Changes of the top-level fields of the sidecars, as ``record_drift`` tells them.
    A sidecar that is null or no object has no fields and is not compared."""
    side = files.select(F.col(file).alias("file"), F.col(metadata).alias("new_json"), F.col(size).alias("new_size"))
    before = side.select(F.col("file").alias("before"), F.col("new_json").alias("old_json"), F.col("new_size").alias("old_size"))
    pairs = order.where(F.col("before").isNotNull()).select("file", "before").join(side, "file").join(before, "before").select("file", "old_json", "new_json", "old_size", "new_size")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def load(text: object) -> dict:
            try:
                value = json.loads(text) if isinstance(text, str) else None
            except ValueError:
                value = None
            return value if isinstance(value, dict) else {}

        for frame in frames:
            out: list[tuple[str, str, str, str]] = []
            for row in frame.itertuples():
                old, new = load(row.old_json), load(row.new_json)
                if not old or not new:
                    continue
                types = [{k: json_type(v) for k, v in x.items()} for x in (old, new)]
                changes = schema_changes(*types)
                gone = [c for c in changes if c[0] == "removed" and c[3] != NULL]
                come = [c for c in changes if c[0] == "added" and c[3] != NULL]
                scored = sorted(
                    (-carried_on(old[g[1]], new[c[2]], row.old_size or 0, row.new_size or 0), g[1], c[2]) for g in gone for c in come if g[3] == c[3]
                )
                taken: dict[str, str] = {}
                for s, g, c in scored:
                    if -s >= RENAME_SHARE and g not in taken and c not in taken.values():
                        taken[g] = c
                out += [(row.file, "renamed", g, c) for g, c in taken.items()]
                out += [(row.file, d, g, c) for d, g, c, _ in changes if not (d == "removed" and g in taken or d == "added" and c in taken.values())]
            yield pd.DataFrame(out, columns=["file", "drift", "old_field", "new_field"])

    return pairs.mapInPandas(run, "file string, drift string, old_field string, new_field string")


# --- one table over all layouts

#: Spark type of each type of the lattice; lists, objects and what no other type holds are kept as JSON text.
SPARK_TYPE = {"boolean": "boolean", "integer": "bigint", "long": "bigint", "number": "double"}
#: Most columns of the union table, those of most records first; the others go to the map ``more``.
MOST_COLUMNS = 2000


def promote(types: set[str]) -> str:
    """Where types meet in the lattice: integer < long < huge and integer < number, all below
    string; array and object meet others in string. Null is below all. No value of a type is
    lost in the type at which it meets others."""
    types = types - {NULL}
    if not types:
        return NULL
    if len(types) == 1:
        return types.pop()
    if types == {"integer", "long"}:
        return "long"
    return "number" if types == {"integer", "number"} else "string"


@dataclass
class UnionSchema:
    """The columns of the union table with their types, and the column of each top-level name."""

    columns: dict[str, str]
    column_of: dict[str, str]


def union_schema(counts: DataFrame, renames: DataFrame, most: int = MOST_COLUMNS) -> UnionSchema:
    """The union of all layouts. Every type that any record shows takes part, not only those
    of most records. Names linked by renames share the column named as in most files. ``counts``:
    file, path, type, n as ``header_counts`` gives them. The driver gets one row per name,
    at most ``most`` names."""
    top = counts.where(F.col("path").startswith(TOP)).withColumn("name", F.substring("path", 2, 1 << 30))
    names = top.groupBy("name").agg(F.sum("n").alias("n"), F.countDistinct("file").alias("files"), F.collect_set("type").alias("types"))
    seen = names.orderBy(F.desc("n"), "name").limit(most).collect()
    plain = ~F.col("old_field").rlike(r"\.|\[\]") & ~F.col("new_field").rlike(r"\.|\[\]")
    files = {r["name"]: r["files"] for r in seen}
    types = {r["name"]: set(r["types"]) for r in seen}
    links = renames.where(plain & F.col("old_field").isin(list(files)) & F.col("new_field").isin(list(files))).select("old_field", "new_field").distinct().collect()
    root = {p: p for p in types}

    def find(x: str) -> str:
        while root[x] != x:
            x = root[x]
        return x

    for r in sorted((r["old_field"], r["new_field"]) for r in links):
        root[find(r[0])] = find(r[1])
    classes: dict[str, list[str]] = {}
    for p in types:
        classes.setdefault(find(p), []).append(p)
    out = UnionSchema({}, {})
    for same in classes.values():
        chief = max(same, key=lambda x: (files[x], x))  # the name of most files
        out.columns[chief] = promote(set().union(*(types[x] for x in same)))
        out.column_of |= {x: chief for x in same}
    out.columns = dict(sorted(out.columns.items()))
    return out


def as_text(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def unified(records: DataFrame, keys: list[str], raw: str, schema: UnionSchema) -> DataFrame:
    """``records`` as one table: ``keys``, each column in its union type, and ``more``, a map of
    name to JSON text with every value that has no cell of its own: a second name of a column
    that the record fills already, and names beyond the columns. Nothing is lost. A column of
    the records that clashes with a key or ``more`` (capitals aside, as column names are
    compared) or an earlier column gets trailing underscores."""
    columns = schema.columns
    named: dict[str, str] = {}
    used = {k.lower() for k in keys} | {"more"}
    for c in columns:
        name = c
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        named[c] = name
    arrow = {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}
    spark_type = {c: SPARK_TYPE.get(t, "string") for c, t in columns.items()}
    kept = records.select(*keys, raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: dict[str, list] = {c: [None] * batch.num_rows for c in columns}
            more: list[list[tuple[str, str]]] = [[] for _ in range(batch.num_rows)]
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                record = json.loads(text)
                # the name that the column has comes first
                for k in sorted(record, key=lambda k: schema.column_of.get(k) != k):
                    v = record[k]
                    if v is None:
                        continue
                    c = schema.column_of.get(k)
                    if c is None or cells[c][i] is not None:
                        more[i].append((k, json.dumps(v, ensure_ascii=False, sort_keys=True)))
                    else:
                        cells[c][i] = as_text(v) if spark_type[c] == "string" else float(v) if spark_type[c] == "double" else v
            arrays = [strings(v) if spark_type[c] == "string" else pa.array(v, arrow[spark_type[c]]) for c, v in cells.items()]
            flat = [x for pairs in more for x in pairs]
            ends = np.cumsum([0, *map(len, more)])
            rest = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), strings(k for k, _ in flat), strings(v for _, v in flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays, rest], names=[*keys, *named.values(), "more"])

    out = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != raw] + ["`{}` {}".format(named[c].replace("`", "``"), t) for c, t in spark_type.items()] + ["more map<string,string>"]
    return kept.mapInArrow(run, ", ".join(out))
