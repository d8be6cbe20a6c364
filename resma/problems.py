"""Queries of the general data problems: rejects (2), drift (3), nesting (4), timestamps (6)."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resma.operators import drift, rejects, shred, timestamps
from resma.plans.cut import cut
from resma.plans.spread import spread
from resma.queries_documents import STRICT
from resma.sources.tables import table


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "dataset_records").select("record_id", "dataset_id", "raw_json"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every failed line with the first reason that applies."""
    return rejects.rejected_records(_lines(spark, folder)).select("record_id", "reason")


def p2_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """The records that load, with the columns of the lines."""
    return rejects.loaded_records(table(spark, folder, "dataset_records"))


def _first_pass(lines: DataFrame, items: Callable[[dict], Iterable[tuple[str, str]]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, layouts, loaded): what ``items`` gives of the records that load, counted by file,
    in the same pass that finds the layouts of the files; and the records that load."""
    classes = cut(rejects.class_counts(lines, "dataset_id", "raw_json", items))
    layouts = cut(rejects.file_layouts(classes))
    counts = rejects.loading_counts(classes, layouts).where(F.col("path").isNotNull())
    named = counts.select(F.when(F.col("_file") != "", F.substring("_file", 2, 1 << 30)).alias("file"), "path", "type", "n")
    return cut(named), layouts, rejects.loaded_records(lines, layouts=layouts)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every change of a record or sidecar layout at the file where it happens."""
    files = table(spark, folder, "datasets").select("dataset_id", "input_path", "metadata_json", "record_count")
    order = cut(drift.file_order(files))
    counts, _, loaded = _first_pass(_lines(spark, folder), drift.record_types)
    records = drift.record_drift(loaded, order, counts=counts)
    sidecars = drift.sidecar_drift(files, order)
    both = records.withColumn("scope", F.lit("record")).unionByName(sidecars.withColumn("scope", F.lit("sidecar")))
    return both.select(F.col("file").alias("dataset_id"), "scope", "drift", "old_field", "new_field")


def p3_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records that load as one table: fields of every layout under one name and type."""
    order = drift.file_order(table(spark, folder, "datasets").select("dataset_id", "input_path"))
    counts, _, loaded = _first_pass(_lines(spark, folder), drift.record_types)
    changes = cut(drift.file_changes(drift.file_schemas(counts), order))
    renames = drift.best_renames(drift.scored_renames(loaded, drift.rename_candidates(changes), "dataset_id", "raw_json", "process_number"))
    return drift.unified(loaded, ["record_id", "dataset_id"], "raw_json", drift.union_schema(counts, renames))


NESTED = shred.Shape(("arquivos", "avisos", "datajud_subjects", "orgao_julgador"), encoded=frozenset({"arquivos"}), whole=frozenset({"orgao_julgador"}))


def _shredded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, shred.Shape]:
    """(loaded records, counts of shapes, what is shredded)."""
    counts, _, loaded = _first_pass(_lines(spark, folder), functools.partial(shred.shapes, shape=NESTED))
    return loaded, counts, dataclasses.replace(NESTED, lists=shred.lone_lists(counts))


def p4_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    """Node, parent, label, ordinal and scalar of the nested fields of all records that load."""
    loaded, _, shape = _shredded(spark, folder)
    return shred.adjacency(loaded, shape)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return shred.nodes(p4_adjacency(spark, folder)).select("record_id", "parent_path", "node_path")


#: Flat tables and the nodes they hold.
ENTITIES = {"p4_files": "arquivos.itens[]", "p4_parts": "arquivos.itens[].partes[]", "p4_notices": "avisos[]", "p4_subjects": "datajud_subjects[]", "p4_courts": "orgao_julgador"}


def _entity(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        loaded, counts, shape = _shredded(spark, folder)
        return shred.entity_table(shred.adjacency(loaded, shape, entity=entity), entity, *shred.entity_labels(counts, entity, shape))

    query.__doc__ = f"The flat table of the nodes {entity}."
    return query


def p6_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every stated time: table_name, row_id, field, value_in, value_out (null where the text
    states no existing moment) and canonical."""
    loaded = rejects.loaded_records(_lines(spark, folder)).select(
        "record_id",
        F.get_json_object("raw_json", "$.distribution_at").alias("distribution_at"),
        F.get_json_object("raw_json", "$.data_ajuizamento").alias("data_ajuizamento"),
    )
    scraped = table(spark, folder, "scrape_results").select("result_id", "retrieved_at")
    stamp, date = F.struct(F.lit("distribution_at").alias("field"), F.col("distribution_at").alias("value")), F.struct(F.lit("data_ajuizamento").alias("field"), F.col("data_ajuizamento").alias("value"))
    records = loaded.select(F.lit("dataset_records").alias("table_name"), F.col("record_id").alias("row_id"), F.explode(F.array(stamp, date)).alias("v")).select("table_name", "row_id", "v.*")
    results = scraped.select(F.lit("scrape_results").alias("table_name"), F.col("result_id").alias("row_id"), F.lit("retrieved_at").alias("field"), F.col("retrieved_at").alias("value"))
    values = records.unionByName(results).where(F.col("value").isNotNull()).withColumn("dated", F.col("field") == "data_ajuizamento")
    return timestamps.normalised(values, "value", "dated").select("table_name", "row_id", "field", F.col("value").alias("value_in"), "value_out", "canonical")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The values not in canonical form that state an existing moment, in canonical form."""
    return p6_values(spark, folder).where(~F.col("canonical") & F.col("value_out").isNotNull()).select("table_name", "row_id", "field", "value_out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found, "p2_loaded": p2_loaded, "p3_found": p3_found, "p3_records": p3_records, "p4_found": p4_found, "p4_adjacency": p4_adjacency, **{name: _entity(entity) for name, entity in ENTITIES.items()},
    "p6_found": p6_found, "p6_values": p6_values,
}


# --- the same in SQL, where it can say it

_JUDGED = STRICT + r""",
told AS (SELECT *, coalesce(raw_json, '') AS line, CASE WHEN NOT ok THEN 'broken_json' WHEN repeats THEN 'duplicate_key' WHEN kind <> 'OBJECT' THEN 'not_object' END AS early FROM strict),
objects AS (SELECT *, list_sort(json_keys(line)) AS layout, regexp_matches(line, '"projudi_internal_id":\s*-?[0-9]+\s*[,}]') AS whole FROM told WHERE early IS NULL),
files AS (SELECT dataset_id, arg_max(layout, (n, len(layout))) AS most, sum(ints) * 2 > sum(n) AS ints FROM (SELECT dataset_id, layout, count(*) AS n, count(*) FILTER (whole) AS ints FROM objects GROUP BY ALL) GROUP BY dataset_id),
members AS (SELECT o.*, f.most, f.ints, json_extract_string(line, '$.process_number') AS number, json_type(line, '$.process_number') = 'VARCHAR' AND regexp_full_match(json_extract_string(line, '$.process_number'), '[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}') AS well FROM objects o JOIN files f ON o.dataset_id IS NOT DISTINCT FROM f.dataset_id),
late AS (SELECT record_id, CASE WHEN layout <> most THEN 'field_set'
WHEN NOT coalesce(well AND 98 - CAST(substr(regexp_replace(number, '[^0-9]', '', 'g'), 1, 7) || substr(regexp_replace(number, '[^0-9]', '', 'g'), 10, 11) || '00' AS HUGEINT) % 97 = CAST(substr(number, 9, 2) AS INT), false) THEN 'process_number'
WHEN NOT coalesce(CASE WHEN ints THEN whole AND NOT regexp_matches(line, '"projudi_internal_id":\s*-') ELSE json_type(line, '$.projudi_internal_id') = 'VARCHAR' AND regexp_full_match(json_extract_string(line, '$.projudi_internal_id'), '[0-9]{1,20}') END, false) THEN 'projudi_internal_id' END AS reason FROM members),
judged AS (SELECT record_id, early AS reason FROM told WHERE early IS NOT NULL UNION ALL SELECT record_id, reason FROM late)"""

# lone elements stand for lists of one; text that encodes an object counts as it
_ADJACENT = _JUDGED + r""",
loaded AS (SELECT d.record_id, d.raw_json FROM dataset_records d JOIN judged j ON d.record_id = j.record_id AND j.reason IS NULL),
fields AS (SELECT record_id, f AS field, json_extract(raw_json, '$.' || f) AS v FROM loaded, (VALUES ('arquivos'), ('avisos'), ('datajud_subjects'), ('orgao_julgador')) t(f)),
decoded AS (SELECT record_id, field, CASE WHEN field = 'arquivos' AND json_type(v) = 'VARCHAR' AND json_valid(json_extract_string(v, '$')) THEN CAST(json_extract_string(v, '$') AS JSON)
WHEN field IN ('avisos', 'datajud_subjects') AND json_type(v) NOT IN ('ARRAY', 'NULL') THEN CAST('[' || v || ']' AS JSON) ELSE v END AS v FROM fields WHERE v IS NOT NULL),
tree AS (SELECT d.record_id, d.field, d.field || substr(t.fullkey, 2) AS path, t.type, json_extract_string(t.value, '$') AS scalar FROM decoded d, json_tree(d.v) t WHERE t.type NOT IN ('NULL', 'ARRAY')),
adjacent AS (SELECT record_id, CASE WHEN contains(path, '.') THEN regexp_replace(path, '\.[^.]*$', '') ELSE '' END AS parent_path, path AS node_path, regexp_replace(path, '\[[0-9]+\]', '[]', 'g') AS entity, regexp_extract(path, '([^.\[\]]+)(\[[0-9]+\])*$', 1) AS label,
try_cast(regexp_extract(path, '\[([0-9]+)\]$', 1) AS INT) AS ordinal, CASE WHEN type = 'OBJECT' OR ends_with(path, ']') OR path = 'orgao_julgador' THEN 'node' ELSE 'scalar' END AS kind, CASE WHEN type <> 'OBJECT' THEN scalar END AS scalar FROM tree)"""

def _entity_sql(entity: str, labels: list[str]) -> str:
    own = f"(SELECT record_id, node_path, parent_path, ordinal, scalar AS value FROM adjacent WHERE kind = 'node' AND entity = '{entity}')"
    members = f"(SELECT record_id, parent_path AS node_path, label, scalar FROM adjacent WHERE kind = 'scalar' AND entity = '{entity}.' || label)"
    return f"WITH {_ADJACENT}, o AS {own}, m AS {members}, w AS (PIVOT (SELECT o.*, m.label, m.scalar FROM o LEFT JOIN m ON o.record_id = m.record_id AND o.node_path = m.node_path) ON label IN ({', '.join(map(repr, labels))}) USING max(scalar) GROUP BY record_id, node_path, parent_path, ordinal, value) SELECT * FROM w"


SQL: dict[str, str] = {
    "p2_found": f"WITH {_JUDGED} SELECT record_id, reason FROM judged WHERE reason IS NOT NULL",
    "p2_loaded": f"WITH {_JUDGED} SELECT d.* FROM dataset_records d JOIN judged j ON d.record_id = j.record_id WHERE j.reason IS NULL",
    "p4_adjacency": f"WITH {_ADJACENT} SELECT * FROM adjacent",
    "p4_found": f"WITH {_ADJACENT} SELECT record_id, parent_path, node_path FROM adjacent WHERE kind = 'node'",
}
#: Labels that the members of each entity have in the test tables; columns of SQL must be named.
_LABELS = {"p4_files": ["id", "paginas", "tipo"], "p4_parts": ["bytes", "ordem"], "p4_notices": ["nivel", "texto"], "p4_subjects": ["codigo", "nome"], "p4_courts": ["codigo", "nome"]}
SQL |= {name: _entity_sql(entity, _LABELS[name]) for name, entity in ENTITIES.items()}
