"""Nested records as an adjacency table, and flat tables per kind of node made from it.

Each record is walked once where it is read. The adjacency table has one row per node and
per scalar member: the node, its parent, label, ordinal and scalar. Object nodes joined with
their scalar children and pivoted by label are the entity tables; record, parent path and
place in the list link them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resma.operators.structural import strings

#: node: an object, list element or whole field; scalar: a member that holds one value;
#: unread: a record nested deeper than the JSON reader goes (thousands of levels), its text as scalar.
ADJACENCY = "record_id long, parent_path string, node_path string, entity string, label string, ordinal int, kind string, scalar string"

#: Parts names of a path by which shapes are counted; lists leave no trace in it.
SEP = "\x1f"
LIST, SINGLE, SCALAR = "list", "single", "scalar"

#: Most labels of an entity that become columns, the most frequent first; the others go to a map.
MOST_LABELS = 500


@dataclass(frozen=True)
class Shape:
    """What is shredded and how. ``encoded``: fields below which text that encodes an object
    counts as it; ``whole``: fields that are nodes in any form; ``lists``: paths (names joined
    by SEP) at which a lone value stands for a list of one."""

    fields: tuple[str, ...]
    encoded: frozenset[str] = frozenset()
    whole: frozenset[str] = frozenset()
    lists: frozenset[str] = frozenset()


def as_object(value: object) -> object:
    """The object that a text encodes, else the value itself."""
    if isinstance(value, str) and value.lstrip()[:1] == "{":
        try:
            found = json.loads(value)
        except (ValueError, RecursionError):
            return value
        return found if isinstance(found, dict) else value
    return value


def shapes(record: dict, shape: Shape) -> list[tuple[str, str]]:
    """(path, shape) of every member of the fields, one visit per node: LIST or SINGLE, and SCALAR
    too if it holds one value. A list's elements and a lone object have their members at the same path."""
    out: list[tuple[str, str]] = []
    stack = [(record.get(f), f, f in shape.encoded) for f in shape.fields]
    while stack:
        value, path, decode = stack.pop()
        if value is None:
            continue
        if decode:
            value = as_object(value)
        level = [value]
        if isinstance(value, list):
            out.append((path, LIST))
            level = value
        else:
            out.append((path, SINGLE))
            if not isinstance(value, dict):
                out.append((path, SCALAR))
                continue
        while level:
            within: list[object] = []
            for x in level:
                if decode:
                    x = as_object(x)
                if isinstance(x, dict):
                    stack.extend((v, f"{path}{SEP}{k}", decode) for k, v in x.items())
                elif isinstance(x, list):
                    within.extend(x)
            level = within
    return out


def lone_lists(counts: DataFrame) -> frozenset[str]:
    """The paths of ``counts`` (path, type, n as ``shapes`` gives them) that hold lists in most
    records that have them and lone values in others. Only such paths, where layouts disagree,
    reach the driver, however many paths there are."""
    n = lambda t: F.sum(F.when(F.col("type") == t, F.col("n")).otherwise(0))
    by_path = counts.where(F.col("path").isNotNull()).groupBy("path").agg(n(LIST).alias("lists"), n(SINGLE).alias("single"))
    return frozenset(r["path"] for r in by_path.where("lists > single AND single > 0").select("path").collect())


def shred(record_id: int, record: dict, shape: Shape) -> list[tuple]:
    """The adjacency rows of one record."""
    out: list[tuple] = []

    def scalar(value: object) -> str:
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)

    # value, path, entity, path of shapes, parent, label, ordinal, decode, element
    stack = [(record.get(f), f, f, f, "", f, None, f in shape.encoded, False) for f in reversed(shape.fields)]
    while stack:
        value, path, entity, names, parent, label, ordinal, decode, element = stack.pop()
        if value is None:
            continue
        if decode:
            value = as_object(value)
        if isinstance(value, list):
            stack.extend((x, f"{path}[{i}]", entity + "[]", names, parent, label, i, decode, True) for i, x in reversed(list(enumerate(value))))
        elif not element and names in shape.lists:
            stack.append((value, path + "[0]", entity + "[]", names, parent, label, 0, decode, True))
        elif isinstance(value, dict):
            out.append((record_id, parent, path, entity, label, ordinal, "node", None))
            stack.extend((v, f"{path}.{k}", f"{entity}.{k}", f"{names}{SEP}{k}", path, k, None, decode, False) for k, v in reversed(value.items()))
        elif element or path in shape.whole:
            out.append((record_id, parent, path, entity, label, ordinal, "node", scalar(value)))
        else:
            out.append((record_id, parent, path, entity, label, ordinal, "scalar", scalar(value)))
    return out


def of_entity(rows: Iterable[tuple], entity: str) -> list[tuple]:
    """The rows of the nodes of ``entity`` and of their scalar members."""
    return [r for r in rows if (r[3] == entity if r[6] == "node" else r[3] == f"{entity}.{r[4]}")]


def adjacency(records: DataFrame, shape: Shape, record_id: str = "record_id", raw: str = "raw_json", entity: str | None = None) -> DataFrame:
    """The adjacency table of the fields of ``shape`` of ``records``, whose ``raw`` holds one JSON object each.

    Lists are no nodes; null elements keep their number but give no row. A lone element where
    other records have a list is element 0. Absent, null and empty fields give no rows. With
    ``entity`` only what its table needs is given.
    """
    names = [x.split()[0] for x in ADJACENCY.split(", ")]
    types = [pa.int64(), *[pa.string()] * 4, pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def made() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([strings(c) if t == pa.string() else pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    found = shred(i, json.loads(text), shape)
                except RecursionError:
                    found = [(i, "", "", "", "", None, "unread", text)]
                rows.extend(of_entity(found, entity) if entity else found)
                if len(rows) > 20_000:
                    yield made()
        if rows:
            yield made()

    return records.select(F.col(record_id).cast("long").alias("record_id"), raw).mapInArrow(run, ADJACENCY)


def nodes(adjacent: DataFrame) -> DataFrame:
    return adjacent.where(F.col("kind") == "node")


def entity_labels(counts: DataFrame, entity: str, shape: Shape, most: int = MOST_LABELS) -> tuple[list[str], bool]:
    """The labels of the scalar members of an entity's nodes, in order: the ``most`` most frequent
    ones, and whether there are others."""
    prefix = entity.replace("[]", "").replace(".", SEP) + SEP
    below = counts.where((F.col("type") == SCALAR) & F.col("path").startswith(prefix)).withColumn("label", F.substring("path", len(prefix) + 1, 1 << 30))
    own = below.where(~F.col("label").contains(SEP) & ~F.col("path").isin(list(shape.lists)))
    found = [r["label"] for r in own.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label").limit(most + 1).collect()]
    return sorted(found[:most]), len(found) > most


def entity_table(adjacent: DataFrame, entity: str, labels: list[str], others: bool = False) -> DataFrame:
    """The nodes of ``entity`` (a path without indices, as ``avisos[]``) with their scalar
    members as columns: record_id, parent_path, node_path, ordinal, value (of text nodes),
    one column per label and, with ``others``, a map of that name with the members of all other
    labels. A label that clashes with these (capitals aside) gets trailing underscores. Lines of
    one record id are one record."""
    own = adjacent.where((F.col("kind") == "node") & (F.col("entity") == entity))
    child = adjacent.where((F.col("kind") == "scalar") & (F.col("entity") == F.concat(F.lit(entity + "."), F.col("label"))))
    both = own.select("record_id", F.col("node_path").alias("node"), "parent_path", "ordinal", F.lit(None).cast("string").alias("label"), "scalar").unionByName(
        child.select("record_id", F.col("parent_path").alias("node"), F.lit(None).cast("string").alias("parent_path"), F.lit(None).cast("int").alias("ordinal"), "label", "scalar")
    )
    used = {"record_id", "parent_path", "node_path", "node", "_node", "ordinal", "value", "others"}
    named: dict[str, str] = {}
    for x in labels:
        named[x] = x
        while named[x].lower() in used:
            named[x] += "_"
        used.add(named[x].lower())
    is_node = F.col("label").isNull()
    other = F.when(~is_node & ~F.col("label").isin(labels), F.struct("label", "scalar"))
    rest = [F.map_from_entries(F.sort_array(F.collect_set(other))).alias("others")] if others else []
    wide = both.groupBy("record_id", "node").agg(
        F.max(F.when(is_node, F.col("parent_path"))).alias("parent_path"),
        F.max(F.when(is_node, F.col("ordinal"))).alias("ordinal"),
        F.max(F.when(is_node, F.col("scalar"))).alias("value"),
        F.max(is_node).alias("_node"),
        *[F.max(F.when(F.col("label") == x, F.col("scalar"))).alias(name) for x, name in named.items()],
        *rest,
    )
    return wide.where("_node").drop("_node").withColumnRenamed("node", "node_path")
