"""Loading lines of JSON files and setting apart, with its reason, each line that fails.

The lines are read by the structural index; two passes are made. The first counts, for each
file, its layouts (sets of top-level field names) and the JSON type of the internal id; the
second judges every line against its file's most common layout. Only one row per file passes
between them, so the lines themselves are never shuffled.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resma.operators.structural import INTEGER, Index, index_lines, slices, strings
from resma.plans.lookup import lookup

# The form of a process number and of an internal id as text.
CNJ = re.compile(rb'"([0-9]{7})-([0-9]{2})\.([0-9]{4})\.([0-9])\.([0-9]{2})\.([0-9]{4})"')
ID_TEXT = re.compile(rb'"[0-9]{1,20}"')

BROKEN, DUPLICATE, NOT_OBJECT, OBJECT = 0, 1, 2, 3
ID_OTHER, ID_GOOD_TEXT, ID_GOOD_INTEGER, ID_BAD_INTEGER = 0, 1, 2, 3

JUDGEMENT = ["_state", "_layout", "_width", "_number_ok", "_id_kind"]
INDEX_SCHEMA = "_state tinyint, _layout long, _width int, _number_ok boolean, _id_kind tinyint"


def plain(value: bytes | None) -> bytes | None:
    """A JSON string with its \\u escapes of ASCII characters written out."""
    if value and value[:1] == b'"' and b"\\" in value:
        return json.dumps(json.loads(value), ensure_ascii=False).encode("utf-8", "surrogatepass")
    return value


def valid_number(value: bytes | None) -> bool:
    m = CNJ.fullmatch(value) if value else None
    if not m:
        return False
    serial, check, year, branch, court, origin = m.groups()
    return int(check) == 98 - int(serial + year + branch + court + origin + b"00") % 97


def id_kind(value: bytes | None) -> int:
    if not value:
        return ID_OTHER
    if ID_TEXT.fullmatch(value):
        return ID_GOOD_TEXT
    if INTEGER.fullmatch(value):
        return ID_BAD_INTEGER if value[:1] == b"-" and value != b"-0" else ID_GOOD_INTEGER
    return ID_OTHER


def indexed_slices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, Index]]:
    """Parts of ``batch`` of about a megabyte of text in its column ``at``, each with its index."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    for start, stop in slices(sizes):
        part = batch.slice(start, stop - start)
        texts = [x or b"" for x in part.column(at).cast(pa.binary()).to_pylist()]
        yield part, index_lines(texts, ("process_number", "projudi_internal_id"))


def judgement(ix: Index) -> list[pa.Array]:
    """The columns of ``INDEX_SCHEMA``."""
    state = np.where(ix.broken, BROKEN, np.where(ix.duplicate, DUPLICATE, np.where(ix.is_object, OBJECT, NOT_OBJECT)))
    ok = [valid_number(plain(v)) for v in ix.fields["process_number"]]
    kinds = [id_kind(plain(v)) for v in ix.fields["projudi_internal_id"]]
    return [pa.array(state, pa.int8()), pa.array(ix.field_hash), pa.array(ix.field_count), pa.array(ok, pa.bool_()), pa.array(kinds, pa.int8())]


def index_records(lines: DataFrame, raw: str = "raw_json") -> DataFrame:
    """``lines`` with the columns of ``INDEX_SCHEMA`` told by the structural index."""
    fields = lines.schema
    names = fields.names
    out_type = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ix in indexed_slices(batch, names.index(raw)):
                yield pa.RecordBatch.from_arrays([*part.columns, *judgement(ix)], names=[*part.schema.names, *JUDGEMENT])

    return lines.mapInArrow(run, ", ".join([*out_type, INDEX_SCHEMA]))


def strict_objects(lines: DataFrame, raw: str = "raw_json", out: str = "record") -> DataFrame:
    """``lines`` with ``out``: the record as a variant where the line is one strict JSON object
    without repeated keys, else null. The strictness is the index's: the engine's own parser
    takes the first value of a line and passes over what follows it."""
    indexed = index_records(lines.drop(out), raw)
    return indexed.withColumn(out, F.when(F.col("_state") == OBJECT, F.try_parse_json(raw))).drop(*JUDGEMENT)


#: What decides, with its file's layouts, whether a line loads.
CLASS = ["_file", "_state", "_layout", "_width", "_number_ok", "_id_kind"]


def class_counts(lines: DataFrame, file: str, raw: str, items: Callable[[dict], Iterable[tuple[str, str]]] | None = None) -> DataFrame:
    """One pass over the lines: (CLASS, path, type, n), the number of lines of each class and, for
    each class of objects, of each (path, type) that ``items`` gives of a record. Rows of null
    path count the lines. Counts are made per megabyte of text where the lines are read."""
    kinds = dict(zip(JUDGEMENT, (pa.int8(), pa.int64(), pa.int32(), pa.bool_(), pa.int8())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ix in indexed_slices(batch, 1):
                classes = list(zip(part.column(0).to_pylist(), *(x.to_pylist() for x in judgement(ix))))
                counts: Counter[tuple] = Counter((*c, None, None) for c in classes)
                if items:
                    for c, text in zip(classes, part.column(1).to_pylist()):
                        if c[1] == OBJECT:
                            try:
                                counts.update((*c, p, t) for p, t in items(json.loads(text)))
                            except RecursionError:  # nested deeper than the JSON reader goes: only the line counts
                                continue
                file_, *judged, path, kind = zip(*counts)
                arrays = [strings(file_), *(pa.array(c, t) for c, t in zip(judged, kinds.values())), strings(path), strings(kind), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["_file", *kinds, "path", "type", "n"])

    found = keyed(lines.select(file, raw), file).select("_file", raw).mapInArrow(run, f"_file string, {INDEX_SCHEMA}, path string, type string, n long")
    return found.groupBy(*CLASS, "path", "type").agg(F.sum("n").alias("n"))


def keyed(lines: DataFrame, file: str) -> DataFrame:
    """``lines`` with ``_file``, one key for the null file too."""
    return lines.withColumn("_file", F.coalesce(F.concat(F.lit("="), F.col(file)), F.lit("")))


def file_layouts(counts: DataFrame) -> DataFrame:
    """One row per file: the layout most of its records have (of equally common ones the one
    with more fields, then the larger hash) and whether most records hold the id as integer."""
    by_layout = (
        counts.where((F.col("_state") == OBJECT) & F.col("path").isNull())
        .groupBy("_file", "_layout", "_width")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_id_kind").isin(ID_GOOD_INTEGER, ID_BAD_INTEGER), F.col("n")).otherwise(0)).alias("ints"))
    )
    return by_layout.groupBy("_file").agg(
        F.max(F.struct("n", "_width", "_layout")).alias("_most"),
        (F.sum("ints") * 2 > F.sum("n")).alias("_int_file"),
    )


def reason() -> Column:
    """The first reason that applies to a class joined with its file's layouts, else null."""
    same_layout = (F.col("_layout") == F.col("_most._layout")) & (F.col("_width") == F.col("_most._width"))
    id_ok = F.when(F.col("_int_file"), F.col("_id_kind") == ID_GOOD_INTEGER).otherwise(F.col("_id_kind") == ID_GOOD_TEXT)
    return (
        F.when(F.col("_state") == BROKEN, "broken_json")
        .when(F.col("_state") == DUPLICATE, "duplicate_key")
        .when(F.col("_state") == NOT_OBJECT, "not_object")
        .when(~same_layout, "field_set")
        .when(~F.col("_number_ok"), "process_number")
        .when(~id_ok, "projudi_internal_id")
    )


def loading_counts(counts: DataFrame, layouts: DataFrame) -> DataFrame:
    """(_file, path, type, n) over the lines that load; null path counts the lines."""
    return lookup(counts, layouts, "_file", cached=True).where(reason().isNull()).groupBy("_file", "path", "type").agg(F.sum("n").alias("n"))


def judge_records(lines: DataFrame, file: str = "dataset_id", raw: str = "raw_json", layouts: DataFrame | None = None) -> DataFrame:
    """``lines`` with ``reason``: null for those that load, else the first of broken_json,
    duplicate_key, not_object, field_set, process_number, projudi_internal_id that applies.

    A null or empty line is broken_json. Lines without a file (null) are judged together as one
    file. Repeated lines are judged alike. An empty table gives an empty result. ``layouts``:
    those of an earlier pass over the same lines (``file_layouts``), materialised.
    """
    known = layouts is not None
    if not known:
        layouts = file_layouts(class_counts(lines, file, raw))
    judged = lookup(index_records(keyed(lines, file), raw), layouts, "_file", cached=known)
    return judged.select(*lines.columns, reason().alias("reason"))


def loaded_records(lines: DataFrame, file: str = "dataset_id", raw: str = "raw_json", layouts: DataFrame | None = None) -> DataFrame:
    """The rows of ``lines`` that load."""
    return judge_records(lines, file, raw, layouts).where(F.col("reason").isNull()).drop("reason")


def rejected_records(lines: DataFrame, file: str = "dataset_id", raw: str = "raw_json") -> DataFrame:
    """The rows of ``lines`` that fail, with ``reason``."""
    return judge_records(lines, file, raw).where(F.col("reason").isNotNull())
