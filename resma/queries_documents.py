"""Queries of record rules, runs, page routing, evaluation and pluggable models, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resma.functions import geometry, numbers, text
from resma.operators import copies, evaluation, models, pages, rejects, runs, sampling, sequences, validation
from resma.queries import QUERIES, SEED, SQL, _annexes, query
from resma.sources.tables import table

# The only host and paths of record URLs, and the digits of branch and court.
HOST, DOWNLOAD, CASE, COURT = "projudi.tribunal.example", "/projudi/acoes/DownloadProcesso", "/projudi/listagens/DadosProcesso", "805"

# strict JSON in SQL: what DuckDB reads beyond it (NaN, commas before a bracket) is told on the text without strings
STRICT = r"""lines AS (SELECT record_id, dataset_id, line_number, raw_json, regexp_replace(coalesce(raw_json, ''), '"(?:[^"\\]|\\.)*"', '""', 'g') AS bare FROM dataset_records),
valid AS (SELECT *, coalesce(json_valid(raw_json), false) AND NOT regexp_matches(bare, '(?i)nan|inf|,\s*[}\]]|/') AND NOT regexp_matches(raw_json, '[\x00-\x1f]') AS ok FROM lines),
twice AS (SELECT DISTINCT record_id FROM (SELECT v.record_id, t.parent, t.key FROM (SELECT * FROM valid WHERE ok) v, json_tree(v.raw_json) t WHERE t.key IS NOT NULL GROUP BY v.record_id, t.parent, t.key HAVING count(*) > 1)),
strict AS (SELECT v.* EXCLUDE bare, t.record_id IS NOT NULL AS repeats, CASE WHEN ok THEN json_type(raw_json) END AS kind FROM valid v LEFT JOIN twice t ON v.record_id = t.record_id)"""

_NUMBER = r"'[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}'"
_INT = "('BIGINT', 'UBIGINT')"


def _json_kind(path: str) -> str:
    return f"json_type(raw_json, '$.{path}')"


def _json_text(path: str) -> str:
    return f"CASE WHEN json_type(raw_json, '$.{path}') = 'VARCHAR' THEN json_extract_string(raw_json, '$.{path}') END"


def _url_sql(field: str, path: str, value: str) -> str:
    return f"coalesce(regexp_full_match({_json_text(field)}, 'https://{HOST}(:443)?{path}\\?numeroProcesso=.*') AND regexp_extract({_json_text(field)}, '\\?numeroProcesso=([^&#]*)$', 1) = {value}, false)"


_REQUIRED_SQL = " AND ".join(f"{_json_kind(f)} IS NOT NULL" for f in validation.REQUIRED)
_RULES = [
    ("object", "ok AND NOT repeats AND kind = 'OBJECT'"), ("missing_fields", _REQUIRED_SQL), ("number_form", f"regexp_full_match(number, {_NUMBER})"),
    ("number_check", "98 - CAST(substr(digits, 1, 7) || substr(digits, 10, 11) || '00' AS HUGEINT) % 97 = CAST(substr(digits, 8, 2) AS INT)"),
    ("digits_differ", f"{_json_text('process_number_digits')} = digits"),
    ("year_differs", f"{_json_kind('process_year')} IN {_INT} AND CAST(json_extract_string(raw_json, '$.process_year') AS BIGINT) = CAST(substr(digits, 10, 4) AS BIGINT)"),
    ("internal_id", "regexp_full_match(internal, '[0-9]{1,20}')"), ("url_download", _url_sql("url_download", DOWNLOAD, "number")), ("source_url", _url_sql("source_url", CASE, "internal")),
    ("court", f"substr(digits, 14, 3) = '{COURT}'"), ("codigo_hash", f"{_json_kind('codigo_hash')} = 'NULL'"), ("is_secret", f"{_json_kind('is_secret')} IN ('NULL', 'BOOLEAN')"),
    ("dates_are_text", f"{_json_kind('distribution_at')} = 'VARCHAR' AND {_json_kind('data_ajuizamento')} = 'VARCHAR'"),
    ("distribution_offset", r"regexp_full_match(moment, '[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})') AND try_cast(substr(moment, 1, 10) AS DATE) IS NOT NULL AND substr(moment, 12, 2) < '24'"),
    ("filing_date", r"regexp_full_match(filed, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(filed AS DATE) IS NOT NULL"),
    ("nullable_texts", " AND ".join(f"{_json_kind(f)} IN ('NULL', 'VARCHAR')" for f in ("subject", "classe", "orgao_julgador"))),
    ("text_lists", " AND ".join(f"{_json_kind(f)} = 'ARRAY' AND len(list_filter(json_type(raw_json, '$.{f}[*]'), lambda t: t <> 'VARCHAR')) = 0" for f in ("datajud_subjects", "avisos"))),
    ("counts", " AND ".join(f"{_json_kind('arquivos.' + f)} IN {_INT} AND CAST(json_extract_string(raw_json, '$.arquivos.{f}') AS HUGEINT) >= 0" for f in ("links_detectados", "restricoes_detectadas"))),
]
# json functions must not see texts that are no JSON
_CHECKED = f"""{STRICT},
parsed AS (SELECT * EXCLUDE raw_json, CASE WHEN ok AND kind = 'OBJECT' THEN raw_json ELSE '{{}}' END AS raw_json FROM strict),
named AS (SELECT *, {_json_text('process_number')} AS number, regexp_replace({_json_text('process_number')}, '[^0-9]', '', 'g') AS digits, {_json_text('projudi_internal_id')} AS internal, {_json_text('distribution_at')} AS moment, {_json_text('data_ajuizamento')} AS filed FROM parsed),
checked AS (SELECT *, CASE {' '.join(f"WHEN NOT coalesce({sql}, false) THEN '{code}'" for code, sql in _RULES)} END AS fault FROM named)"""


def _rules(record):
    return validation.record_rules(record, HOST, DOWNLOAD, CASE, COURT)


@query(f"WITH {_CHECKED} SELECT record_id, fault FROM checked")
def flt_record_rules(spark: SparkSession, folder: str) -> DataFrame:
    """FLT01, JS02, AR02: the first rule of a case record that each line breaks, null if none."""
    lines = table(spark, folder, "dataset_records").select("record_id", "raw_json")
    return validation.checked_records(lines, _rules).select("record_id", "fault")


@query(f"WITH {_CHECKED} SELECT dataset_id, min(line_number) AS line_number, arg_min(fault, line_number) AS fault FROM checked WHERE fault IS NOT NULL GROUP BY dataset_id")
def src_first_error(spark: SparkSession, folder: str) -> DataFrame:
    """SRC01: the first line of each file that breaks a rule, and which."""
    lines = table(spark, folder, "dataset_records").select("dataset_id", "line_number", "raw_json")
    return validation.first_error(validation.checked_records(lines, _rules), "dataset_id", "line_number", "fault")


@query(f"""WITH {_CHECKED}, k AS (SELECT record_id, dataset_id, line_number, number, internal FROM checked WHERE ok AND NOT repeats AND kind = 'OBJECT')
SELECT record_id, least(min(CASE WHEN number IS NOT NULL THEN n1 END), min(CASE WHEN internal IS NOT NULL THEN n2 END)) AS duplicate_of FROM
(SELECT *, nullif(min(line_number) OVER (PARTITION BY dataset_id, number), line_number) AS n1, nullif(min(line_number) OVER (PARTITION BY dataset_id, internal), line_number) AS n2 FROM k) GROUP BY record_id""")
def win_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """WN14: the line before with the same process number or internal id."""
    lines = rejects.strict_objects(table(spark, folder, "dataset_records").select("record_id", "dataset_id", "line_number", "raw_json"), out="r")
    text_of = lambda n: F.when(validation.json_kind(F.col("r"), f"$.{n}") == "STRING", validation.member(F.col("r"), f"$.{n}", "string"))
    keyed = lines.where("r IS NOT NULL").select("record_id", "dataset_id", "line_number", text_of("process_number").alias("number"), text_of("projudi_internal_id").alias("internal"))
    return validation.first_seen(keyed, "dataset_id", "line_number", ["number", "internal"]).select("record_id", "duplicate_of")


_COVERAGE = f"""{STRICT}, o AS (SELECT dataset_id, raw_json FROM strict WHERE ok AND NOT repeats AND kind = 'OBJECT'),
present AS (SELECT o.dataset_id, t.key AS field, count(*) AS present FROM o, json_each(o.raw_json) t WHERE t.type <> 'NULL' GROUP BY o.dataset_id, t.key)"""


@query(f"WITH {_COVERAGE} SELECT * FROM present")
def agg_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """AG04: records of each file in which a field is not null."""
    return validation.field_coverage(table(spark, folder, "dataset_records").select("dataset_id", "raw_json"), "dataset_id")


@query(f"""WITH {_COVERAGE}, said AS (SELECT dataset_id, t.key AS field, try_cast(json_extract_string(t.value, '$') AS BIGINT) AS stated FROM datasets d, json_each(json_extract(d.metadata_json, '$.cobertura_campos')) t)
SELECT s.dataset_id, s.field, s.stated, coalesce(p.present, 0) AS present FROM said s LEFT JOIN present p ON s.dataset_id = p.dataset_id AND s.field = p.field WHERE s.stated IS DISTINCT FROM coalesce(p.present, 0)""")
def src_coverage_differences(spark: SparkSession, folder: str) -> DataFrame:
    """SRC03, AG04: where a sidecar states another coverage than its records have."""
    return validation.coverage_differences(table(spark, folder, "datasets"), agg_coverage(spark, folder))


@query("SELECT dataset_id, json_extract_string(metadata_json, '$.version_esquema') AS version, json_type(metadata_json, '$.version_esquema') IN ('UBIGINT', 'BIGINT') AND json_extract_string(metadata_json, '$.version_esquema') = '2' AS supported FROM datasets WHERE json_extract_string(metadata_json, '$.version_esquema') IS NOT NULL")
def src_schema_version(spark: SparkSession, folder: str) -> DataFrame:
    """SRC03: the layout version of each sidecar and whether it is the supported one (the integer 2)."""
    v = F.try_parse_json("metadata_json")
    version, kind = validation.member(v, "$.version_esquema", "string"), validation.json_kind(v, "$.version_esquema")
    return table(spark, folder, "datasets").where(version.isNotNull()).select("dataset_id", version.alias("version"), ((kind == "BIGINT") & (version == "2")).alias("supported"))


# --- sets and constraints


@query(f"WITH {STRICT} SELECT record_id, list_sort(list_filter({validation.REQUIRED!r}, lambda f: NOT list_contains(json_keys(raw_json), f))) AS missing FROM strict WHERE ok AND NOT repeats AND kind = 'OBJECT'")
def st_missing_fields(spark: SparkSession, folder: str) -> DataFrame:
    """ST01: the required fields that a record lacks."""
    lines = rejects.strict_objects(table(spark, folder, "dataset_records").select("record_id", "raw_json"), out="r")
    return lines.where("r IS NOT NULL").select("record_id", validation.missing_fields(F.col("r")).alias("missing"))


@query("SELECT DISTINCT case_id FROM dataset_records WHERE case_id IS NOT NULL AND case_id NOT IN (SELECT case_id FROM case_documents WHERE case_id IS NOT NULL)")
def jn_not_within(spark: SparkSession, folder: str) -> DataFrame:
    """JN16: cases of records that no document belongs to."""
    return validation.not_within(table(spark, folder, "dataset_records").where("case_id IS NOT NULL"), table(spark, folder, "case_documents"), ["case_id"])


@query("SELECT 'sha256' AS key, sha256 AS value FROM case_documents WHERE validation_status = 'valid' INTERSECT SELECT 'sha256', sha256 FROM scrape_results UNION ALL (SELECT 'size_bytes', CAST(size_bytes AS VARCHAR) FROM case_documents WHERE validation_status = 'valid' AND size_bytes IS NOT NULL INTERSECT SELECT 'size_bytes', CAST(size_bytes AS VARCHAR) FROM scrape_results)")
def st_shared(spark: SparkSession, folder: str) -> DataFrame:
    """ST03: what valid documents and results share on each key; disjoint sets share nothing."""
    valid = table(spark, folder, "case_documents").where("validation_status = 'valid'")
    return validation.shared(valid, table(spark, folder, "scrape_results"), ["sha256", "size_bytes"])


@query("""SELECT (SELECT count(*) FROM (SELECT DISTINCT source_sha256 FROM page_cache EXCEPT SELECT sha256 FROM case_documents)) AS only_cached, (SELECT count(*) FROM (SELECT sha256 FROM case_documents EXCEPT SELECT source_sha256 FROM page_cache)) AS only_documents""")
def st_equal(spark: SparkSession, folder: str) -> DataFrame:
    """ST04: sources cached and documents: what either set has and the other lacks."""
    a = table(spark, folder, "page_cache").select(F.col("source_sha256").alias("sha256")).distinct().withColumn("a", F.lit(1))
    b = table(spark, folder, "case_documents").select("sha256").distinct().withColumn("b", F.lit(1))
    return a.join(b, "sha256", "full_outer").agg(F.count_if(F.col("b").isNull()).alias("only_cached"), F.count_if(F.col("a").isNull()).alias("only_documents"))


_PROBED = """probed AS (SELECT source_sha256, start, unnest(range(start, least(last, start + 1) + 1)) AS page FROM (SELECT DISTINCT p.source_sha256, p.page.page_number AS start, d.page_count AS last FROM page_cache p JOIN case_documents d ON d.sha256 = p.source_sha256
WHERE p.page.page_number = 1 OR (contains(p.page.text, 'DA ADES') AND p.page.page_number IS NOT NULL)))"""


@query(f"WITH {_PROBED} SELECT source_sha256, page, count(*) AS items FROM probed GROUP BY source_sha256, page HAVING count(*) > 1")
def st_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """ST08: pages that the first two pages of more than one part claim."""
    parts = _annexes(spark, folder).where("last >= start").select("source_sha256", F.sequence("start", F.least(F.col("last"), F.col("start") + 1)).alias("pages"))
    return validation.overlapping_positions(parts, "source_sha256", "pages").withColumn("page", F.col("page").cast("long"))


@query("""SELECT source_sha256, configuration_sha256, max(n) - min(n) + 1 = count(DISTINCT n) AS consecutive FROM (SELECT source_sha256, configuration_sha256, page.page_number AS n FROM page_cache WHERE page.page_number IS NOT NULL) GROUP BY 1, 2""")
def st_consecutive(spark: SparkSession, folder: str) -> DataFrame:
    """ST08: whether the cached pages of a source are a run without gap."""
    p = table(spark, folder, "page_cache").where("page.page_number IS NOT NULL").groupBy("source_sha256", "configuration_sha256").agg(F.array_sort(F.collect_set("page.page_number")).alias("pages"))
    return p.select("source_sha256", "configuration_sha256", validation.is_consecutive(F.col("pages")).alias("consecutive"))


@query("SELECT document_id, case_id FROM (SELECT d.document_id, d.case_id, d.retrieved_at FROM case_documents d JOIN cases c ON d.case_id = c.case_id WHERE validation_status = 'valid') ORDER BY retrieved_at DESC, document_id LIMIT 2")
def jn_newest(spark: SparkSession, folder: str) -> DataFrame:
    """JN07, TK08: the newest two valid documents of known cases."""
    docs = table(spark, folder, "case_documents").where("validation_status = 'valid'").select("document_id", "case_id", "retrieved_at")
    return validation.latest_n(docs.join(table(spark, folder, "cases").select("case_id"), "case_id"), [F.desc("retrieved_at"), F.asc("document_id")], 2).select("document_id", "case_id")


@query("SELECT record_id, row_number() OVER (ORDER BY dataset_id, line_number, record_id) AS position FROM (SELECT * FROM dataset_records ORDER BY dataset_id, line_number, record_id LIMIT 25)")
def smp_first(spark: SparkSession, folder: str) -> DataFrame:
    """TK01, WN23: the first rows in the order of the files, with their positions."""
    rows = table(spark, folder, "dataset_records").select("record_id", "dataset_id", "line_number")
    return validation.partition_first(rows, 25, "dataset_id", "line_number", "record_id").select("record_id", F.col("position").cast("long").alias("position"))


@query("SELECT page_id, len(words) AS n, CASE WHEN len(words) = len(rects) THEN len(words) END AS paired FROM (SELECT page_id, coalesce(page.words, []) AS words, coalesce(page.image_rects, []) AS rects FROM page_cache)")
def jn_zipped(spark: SparkSession, folder: str) -> DataFrame:
    """JN15: words with images by position; null where there are more of one."""
    p = table(spark, folder, "page_cache").select("page_id", F.coalesce("page.words", F.array()).alias("words"), F.coalesce("page.image_rects", F.array()).alias("rects"))
    paired = validation.zipped(F.col("words"), F.col("rects"))
    return p.select("page_id", F.size("words").cast("long").alias("n"), F.when(paired.isNotNull(), F.size(paired)).cast("long").alias("paired"))


# --- pages

_PAGES = """pg AS (SELECT source_sha256 AS s, configuration_sha256 AS c, page.page_number AS n, max(page.text) AS t, max(page.text_method) AS m, max(page.image_fraction) AS f, max(page.ocr_error) AS e FROM page_cache
WHERE page.page_number IS NOT NULL AND source_sha256 IS NOT NULL AND configuration_sha256 IS NOT NULL GROUP BY 1, 2, 3),
counted AS (SELECT *, CASE WHEN t IS NULL OR t = '' THEN 'U' WHEN contains(t, 'DA ADES') THEN 'A' WHEN contains(t, 'DOS ENCARGOS') THEN 'E' WHEN contains(t, 'Ouvidoria') THEN 'C' ELSE 'N' END AS role,
list_extract(list_filter(list_transform(regexp_extract_all(t, '\\b[0-9]{1,2}\\s*(?:/|de)\\s*[0-9]{1,2}\\b'), lambda m: [CAST(regexp_extract(m, '^([0-9]+)', 1) AS INT), CAST(regexp_extract(m, '([0-9]+)$', 1) AS INT)]), lambda p: p[1] BETWEEN 1 AND 60 AND p[2] BETWEEN 1 AND 60), -1) AS k FROM pg),
linked AS (SELECT a.*, b.n IS NOT NULL AS adjacent, CASE WHEN a.k[1] = b.k[1] + 1 AND a.k[2] = b.k[2] THEN 'consecutive_counter' WHEN contains(a.t, 'anexo') THEN 'content' END AS continues FROM counted a LEFT JOIN counted b ON a.s = b.s AND a.c = b.c AND b.n = a.n - 1)"""
ENTITY = ["s", "c"]


def _page_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page of a source and configuration with its role, printed counter and whether it goes on."""
    p = table(spark, folder, "page_cache").where("page.page_number IS NOT NULL AND source_sha256 IS NOT NULL AND configuration_sha256 IS NOT NULL")
    one = p.groupBy(F.col("source_sha256").alias("s"), F.col("configuration_sha256").alias("c"), F.col("page.page_number").alias("n")).agg(
        F.max("page.text").alias("t"), F.max("page.text_method").alias("m"), F.max("page.image_fraction").alias("f"), F.max("page.ocr_error").alias("e"))
    t = F.col("t")
    role = F.when(t.isNull() | (t == ""), "U").when(t.contains("DA ADES"), "A").when(t.contains("DOS ENCARGOS"), "E").when(t.contains("Ouvidoria"), "C").otherwise("N")
    return pages.continuations(one.withColumn("role", role).withColumn("k", text.printed_counter(t)), ENTITY, "n", "k", otherwise=t.contains("anexo"))


@query(f"WITH {_PAGES} SELECT a.s, a.c, a.n, b.m AS before_m, d.m AS after_m FROM pg a LEFT JOIN pg b ON a.s = b.s AND a.c = b.c AND b.n = a.n - 1 LEFT JOIN pg d ON a.s = d.s AND a.c = d.c AND d.n = a.n + 1")
def win_context(spark: SparkSession, folder: str) -> DataFrame:
    """JN14: how the pages before and after each page were read."""
    one = _page_table(spark, folder).select(*ENTITY, "n", "m")
    return pages.in_neighbours(one, ENTITY, "n", ["m"]).select(*ENTITY, "n", "before_m", "after_m")


@query(f"WITH {_PAGES} SELECT s, c, n, continues FROM linked WHERE continues IS NOT NULL")
def win_continues(spark: SparkSession, folder: str) -> DataFrame:
    """WN21, FLT13: pages that go on from the page before, by printed counters or content."""
    return _page_table(spark, folder).where("continues IS NOT NULL").select(*ENTITY, "n", "continues")


@query(f"""WITH {_PAGES}, isl AS (SELECT *, sum(CASE WHEN adjacent AND continues IS NOT NULL AND role NOT IN ('A', 'B', 'F', 'U') THEN 0 ELSE 1 END) OVER (PARTITION BY s, c ORDER BY n ROWS UNBOUNDED PRECEDING) AS island FROM linked),
chain AS (SELECT s, c, island, min(n) AS low, max(n) AS high, count(*) AS size, arg_min(role IN ('A', 'B') AND coalesce(k[1] = 1 AND k[2] > 1, false), n) AS starts, arg_max(role = 'E' OR contains(coalesce(t, ''), 'Ouvidoria'), n) AS ends, arg_min(coalesce(k, [0, 0]), n)[2] AS total, arg_max(coalesce(k, [0, 0]), n) AS last FROM isl GROUP BY s, c, island),
good AS (SELECT * FROM chain WHERE starts AND size > 1 AND (ends OR (last[1] = total AND last[2] = total AND total = size)))
SELECT i.s, i.c, i.n, i.role, CASE WHEN g.low IS NULL THEN i.role WHEN i.n = g.low THEN 'A' WHEN i.n = g.high THEN 'E' ELSE 'C' END AS resolved FROM isl i LEFT JOIN good g ON i.s = g.s AND i.c = g.c AND i.island = g.island""")
def win_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """WN05, WN06: roles after chains of printed counters are repaired; any content supports them."""
    p = _page_table(spark, folder)
    fixed = pages.repaired_roles(p, ENTITY, "n", "role", "k", "continues", F.lit(True), F.col("t").contains("Ouvidoria"))
    return fixed.select(*ENTITY, "n", "role", "resolved")


@query(f"""WITH {_PAGES} SELECT a.s, a.c, a.n, CASE WHEN a.role IN ('B', 'E') AND d.role NOT IN ('A', 'B', 'F') AND (d.continues IS NOT NULL OR d.role IN ('C', 'E')) THEN 'early_end' ELSE 'gap' END AS why
FROM linked a JOIN linked d ON a.s = d.s AND a.c = d.c AND d.n = a.n + 1 LEFT JOIN linked b ON a.s = b.s AND a.c = b.c AND b.n = a.n - 1
WHERE (a.role IN ('B', 'E') AND d.role NOT IN ('A', 'B', 'F') AND (d.continues IS NOT NULL OR d.role IN ('C', 'E'))) OR (a.role = 'N' AND b.role IN ('A', 'C') AND d.role IN ('C', 'E'))""")
def win_suspects(spark: SparkSession, folder: str) -> DataFrame:
    """WN07: pages whose role may end or part something too early."""
    return pages.boundary_suspects(_page_table(spark, folder), ENTITY, "n", "role", "continues")


_RANGES = """starts AS (SELECT DISTINCT p.source_sha256 AS s, p.page.page_number AS start, d.page_count AS last, contains(max(p.page.text) OVER (PARTITION BY p.source_sha256, p.page.page_number), 'DA ADES') AS titled FROM page_cache p JOIN case_documents d ON d.sha256 = p.source_sha256
WHERE p.page.page_number IS NOT NULL AND (p.page.page_number = 1 AND p.source_sha256 < '8' OR contains(p.page.text, 'DA ADES'))),
parts AS (SELECT s, start, last, titled, coalesce(lead(start) OVER (PARTITION BY s ORDER BY start) - 1, last) AS stop FROM starts),
okay AS (SELECT s, bool_and(ok) AND max(stop) = max(last) AS whole FROM (SELECT *, start = coalesce(lag(stop) OVER (PARTITION BY s ORDER BY start), 0) + 1 AND stop >= start AS ok FROM parts) GROUP BY s),
cr AS (SELECT p.s, p.start, p.stop, true AS indexed, titled FROM parts p JOIN okay o ON p.s = o.s AND o.whole
UNION ALL SELECT d.sha256, 1, d.page_count, false, NULL FROM case_documents d LEFT JOIN okay o ON d.sha256 = o.s WHERE NOT coalesce(o.whole, false))"""


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(ranges, documents): sources of the upper half of hashes have no range for their first pages, so some documents fall back to one range."""
    docs = table(spark, folder, "case_documents").select(F.col("sha256").alias("s"), F.col("page_count").alias("last"))
    p = table(spark, folder, "page_cache").where("page.page_number IS NOT NULL").select(F.col("source_sha256").alias("s"), F.col("page.page_number").alias("start"), F.col("page.text").alias("t"))
    begins = ((F.col("start") == 1) & (F.col("s") < "8")) | F.col("t").contains("DA ADES")
    starts = p.groupBy("s", "start").agg(F.max(F.coalesce(begins, F.lit(False))).alias("begins"), F.max("t").contains("DA ADES").alias("titled")).where("begins").drop("begins")
    return sequences.ranges_from_starts(starts.join(docs, "s"), ["s"], "start", "last"), docs


def _content_ranges(spark: SparkSession, folder: str) -> DataFrame:
    ranges, docs = _parts(spark, folder)
    return pages.content_ranges(ranges, docs, ["s"], "start", "stop", "last").join(ranges.select("s", "start", "titled"), ["s", "start"], "left").withColumn("titled", F.when(F.col("indexed"), F.col("titled")))


@query(f"WITH {_RANGES} SELECT s, start, stop, indexed FROM cr")
def win_content_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """WN03: ranges that cover their document, else the whole document as one."""
    return _content_ranges(spark, folder).select("s", "start", "stop", "indexed")


@query(f"""WITH {_RANGES}, hits AS (SELECT DISTINCT source_sha256 AS s, page.page_number AS n FROM page_cache WHERE contains(page.text, 'Ouvidoria') AND page.page_number IS NOT NULL),
told AS (SELECT s, start, stop, CASE WHEN titled THEN 8 ELSE 0 END AS score, indexed, EXISTS (SELECT 1 FROM hits h WHERE h.s = cr.s AND h.n BETWEEN start AND least(stop, start + 1)) AS hit FROM cr),
chosen AS (SELECT *, indexed AND (score >= 4 OR hit) AS selected FROM told)
SELECT s, start, stop, score, hit, selected, CASE WHEN selected THEN row_number() OVER (PARTITION BY s, selected ORDER BY score DESC, start) END AS place FROM chosen""")
def pipe_planned(spark: SparkSession, folder: str) -> DataFrame:
    """PIPE01, TK06, TK07: parts chosen by the score of their title or a hit on their first two pages."""
    p = table(spark, folder, "page_cache").select(F.col("source_sha256").alias("s"), F.col("page.page_number").alias("n"), F.col("page.text").alias("t"))
    score = F.when(F.col("titled"), 8).otherwise(0)
    planned = pages.planned_groups(_content_ranges(spark, folder), p, ["s"], "start", "stop", "n", F.col("t").contains("Ouvidoria"), score, 4)
    return planned.withColumn("place", F.col("place").cast("long"))


@query(f"""WITH {_RANGES}, pgs AS (SELECT source_sha256 AS s, page.page_number AS n, bool_or(contains(coalesce(page.text, ''), 'DOS ENCARGOS')) AS strong, bool_or(page.ocr_error IS NOT NULL OR (coalesce(page.image_fraction, 0) > 0.5 AND length(coalesce(page.text, '')) < 100)) AS unsure, bool_or(page.text_method = 'native') AS done FROM page_cache WHERE page.page_number IS NOT NULL GROUP BY 1, 2),
each AS (SELECT cr.s, cr.start, cr.stop, cr.titled, p.n, p.strong, p.unsure FROM cr LEFT JOIN pgs p ON p.s = cr.s AND p.n BETWEEN cr.start AND cr.stop),
told AS (SELECT s, start, stop, bool_or(coalesce(titled, false)) OR coalesce(bool_or(strong), false) AS whole FROM each GROUP BY s, start, stop),
picked AS (SELECT s, unnest(range(start, stop + 1)) AS n FROM told WHERE whole UNION SELECT e.s, unnest(range(greatest(e.start, e.n - 1), least(e.stop, e.n + 1) + 1)) FROM each e JOIN told t ON e.s = t.s AND e.start = t.start AND e.stop = t.stop WHERE NOT t.whole AND e.unsure)
SELECT s, n FROM picked p WHERE NOT EXISTS (SELECT 1 FROM pgs d WHERE d.s = p.s AND d.n = p.n AND d.done)""")
def pipe_residual(spark: SparkSession, folder: str) -> DataFrame:
    """PIPE02, ST06: pages still to look at; native pages count as classified."""
    p = table(spark, folder, "page_cache").where("page.page_number IS NOT NULL").select(F.col("source_sha256").alias("s"), F.col("page.page_number").alias("n"), "page")
    t = F.coalesce("page.text", F.lit(""))
    unsure = F.col("page.ocr_error").isNotNull() | ((F.coalesce("page.image_fraction", F.lit(0.0)) > 0.5) & (F.length(t) < 100))
    one = p.groupBy("s", "n").agg(F.max(t.contains("DOS ENCARGOS")).alias("strong"), F.max(unsure).alias("unsure"), F.max(F.coalesce(F.col("page.text_method") == "native", F.lit(False))).alias("done"))
    rest = pages.residual_pages(_content_ranges(spark, folder), one, ["s"], "start", "stop", "n", F.col("strong"), F.col("titled"), F.col("unsure"), one.where("done"))
    return rest.select("s", F.col("n").cast("long").alias("n"))


@query(f"""WITH {_PAGES}, r AS (SELECT DISTINCT sha256 AS s, unnest(range(1, page_count + 1, 2)) AS start, page_count AS last FROM case_documents)
SELECT a.s, a.c, a.n AS stop, b.n AS start FROM r JOIN linked a ON a.s = r.s AND a.n = r.start + 1 AND r.start + 2 <= r.last JOIN linked b ON b.s = a.s AND b.c = a.c AND b.n = a.n + 1
WHERE a.role IN ('A', 'B', 'C', 'E') AND b.role NOT IN ('B', 'F', 'U') AND (b.role IN ('C', 'E') OR b.continues IS NOT NULL)""")
def win_crossings(spark: SparkSession, folder: str) -> DataFrame:
    """WN22, PIPE05: borders of parts (here of two pages each) that an instrument may cross."""
    p = _page_table(spark, folder)
    docs = table(spark, folder, "case_documents").select(F.col("sha256").alias("s"), F.col("page_count").alias("last")).distinct()
    parts = docs.where("last >= 1").select("s", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2))).alias("start")).select("s", "start", F.least(F.col("start") + 1, F.col("last")).alias("stop"))
    return pages.crossing_candidates(parts.join(p.select("s", "c").distinct(), "s"), p, ENTITY, "start", "stop", "n", "role", "continues")


@query("""WITH w AS (SELECT page_id, page.width AS pw, page.height AS ph, page.image_rects AS rects, coalesce(page.words, []) AS words, page.image_fraction AS f, page.text AS t FROM page_cache)
SELECT page_id, coalesce(len(list_filter(rects, lambda r: greatest(r[3] - r[1], 0) * greatest(r[4] - r[2], 0) >= 0.05 * pw * ph AND coalesce(list_sum(list_transform(list_filter(words, lambda x: x.x0 >= r[1] AND x.y0 >= r[2] AND x.x1 <= r[3] AND x.y1 <= r[4]), lambda x: length(x.text))), 0) < 80)) > 0, false)
OR coalesce(f > 0.1 AND length(coalesce(t, '')) < 300, false) AS needed FROM w""")
def flt_needs_recognition(spark: SparkSession, folder: str) -> DataFrame:
    """FLT07: pages whose own text is not enough."""
    p = table(spark, folder, "page_cache").select("page_id", "page.*")
    t = F.coalesce("text", F.lit(""))
    hidden = pages.hidden_image(F.col("image_rects"), F.col("words"), F.col("width"), F.col("height"))
    return p.select("page_id", pages.needs_recognition(F.coalesce("image_fraction", F.lit(0.0)), hidden, F.length(t), text.text_faults(t), F.lit(0)).alias("needed"))


# --- runs

_EVENTS = """ev AS (SELECT result_id AS seq, run_id, CASE result_id % 4 WHEN 0 THEN 'start' WHEN 1 THEN 'attempt:page' WHEN 2 THEN 'attempt:pdf' ELSE 'finish' END AS kind, retrieved_at AS moment, status, size_bytes AS bytes, repeat(subject, 40) AS error FROM
(SELECT *, substr(run_id, 1, 2) AS r FROM scrape_results)), e AS (SELECT * EXCLUDE run_id, substr(run_id, 1, 2) AS run FROM ev)"""


@query(f"""WITH {_EVENTS} SELECT run, min(moment) FILTER (kind = 'start') AS started_at, arg_max_null(moment, seq) FILTER (kind = 'finish') AS finished_at, coalesce(arg_max_null(status, seq) FILTER (kind = 'finish'), 'running') AS status, arg_max_null(bytes, seq) FILTER (kind = 'finish') AS bytes,
substr(arg_max_null(error, seq) FILTER (kind = 'finish'), 1, 500) AS error, 0 AS bootstrap_attempts, count(*) FILTER (kind = 'attempt:page') AS page_attempts, 0 AS resolve_attempts, count(*) FILTER (kind = 'attempt:pdf') AS pdf_attempts, 0 AS session_attempts FROM e GROUP BY run""")
def snk_run_states(spark: SparkSession, folder: str) -> DataFrame:
    """SNK04: the state of runs from their append-only events (runs: the first two digits of the run id)."""
    r = F.col("result_id") % 4
    kind = F.when(r == 0, "start").when(r == 1, "attempt:page").when(r == 2, "attempt:pdf").otherwise("finish")
    events = table(spark, folder, "scrape_results").select(F.col("result_id").alias("seq"), F.substring("run_id", 1, 2).alias("run"), kind.alias("kind"), F.col("retrieved_at").alias("at"), "status", F.col("size_bytes").alias("bytes"), F.repeat("subject", F.lit(40)).alias("error"))
    return runs.run_states(events, "run", "seq")


@query("SELECT result_id FROM scrape_results WHERE status IS NULL OR status NOT IN ('processing_needs_review', 'secret_skipped')")
def flt_resume(spark: SparkSession, folder: str) -> DataFrame:
    """FLT21: what a resumed batch goes on with."""
    return runs.to_resume(table(spark, folder, "scrape_results").select("result_id", "status"), "status", ("processing_needs_review",), ("secret_skipped",)).select("result_id")


@query("SELECT document_id, EXISTS (SELECT 1 FROM page_cache p WHERE p.source_sha256 = d.sha256 AND p.page.text <> '' AND p.page.page_number = d.page_count) AS reuse FROM case_documents d")
def flt_reusable(spark: SparkSession, folder: str) -> DataFrame:
    """FLT22, SRC10: documents whose last page is cached with a text, bound by source and page."""
    docs = table(spark, folder, "case_documents").select("document_id", F.col("sha256").alias("source_sha256"), F.col("page_count").alias("n"))
    cached = table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("n"), F.col("page.text").alias("t"))
    return runs.reusable(docs, cached, ["source_sha256", "n"], F.col("t") != "").select("document_id", "reuse")


@query("""SELECT d.document_id, p.c AS configuration FROM case_documents d JOIN (SELECT source_sha256 AS s, configuration_sha256 AS c, count(DISTINCT page.page_number) AS k, min(page.page_number) AS low, max(page.page_number) AS high FROM page_cache WHERE page.page_number IS NOT NULL GROUP BY 1, 2) p
ON p.s = d.sha256 AND p.k = d.page_count AND p.low = 1 AND p.high = d.page_count""")
def src_whole_documents(spark: SparkSession, folder: str) -> DataFrame:
    """SRC09: caches that hold exactly the pages 1 to n of their document."""
    docs = table(spark, folder, "case_documents").select("document_id", F.col("sha256").alias("source_sha256"), "page_count")
    cached = table(spark, folder, "page_cache").select("source_sha256", F.col("configuration_sha256").alias("configuration"), F.col("page.page_number").alias("n"))
    wanted = docs.join(cached.select("source_sha256", "configuration").distinct(), "source_sha256")
    return runs.whole_documents(cached, wanted, ["source_sha256", "configuration"], "n", "page_count").select("document_id", "configuration")


@query(f"""WITH r AS (SELECT document_id, sha256, row_number() OVER (ORDER BY sha256('{SEED}:' || document_id), document_id) AS nth FROM case_documents),
lists AS (SELECT document_id, CASE WHEN nth % 2 = 0 THEN sha256 ELSE 'other' END AS sha, CASE WHEN nth <= 20 THEN 'holdout' ELSE 'development' END AS role FROM r WHERE nth <= 60)
SELECT d.document_id, CASE WHEN l.role IS NULL THEN 'unknown' WHEN l.sha <> d.sha256 THEN 'changed' WHEN l.role = 'holdout' THEN 'frozen_first' ELSE l.role END AS authorization FROM case_documents d LEFT JOIN lists l ON d.document_id = l.document_id""")
def flt_admitted(spark: SparkSession, folder: str) -> DataFrame:
    """FLT14: which sources a run may read before its configuration is frozen; every other listed hash is made a wrong one."""
    docs = table(spark, folder, "case_documents").select("document_id", "sha256")
    listed = sampling.split(docs, "document_id", {"holdout": 20, "development": 40}, SEED)
    nth = F.row_number().over(sampling.Window.orderBy("rank", "document_id"))  # 60 rows
    listed = listed.withColumn("nth", nth).withColumn("sha256", F.when(F.col("nth") % 2 == 0, F.col("sha256")).otherwise("other"))
    role = lambda r: listed.where(F.col("role") == r).select("document_id", "sha256")
    return runs.admitted(docs, role("development"), role("holdout"), "document_id", "sha256", frozen=False).select("document_id", "authorization")


@query("""WITH a AS (SELECT DISTINCT sha256 AS path, sha256, size_bytes FROM case_documents WHERE validation_status = 'valid'), b AS (SELECT sha256 AS path, max(sha256) AS sha256, max(size_bytes) AS size_bytes FROM scrape_results WHERE sha256 IS NOT NULL GROUP BY 1)
SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'extra' WHEN b.path IS NULL THEN 'missing' WHEN a.size_bytes IS NOT DISTINCT FROM b.size_bytes AND a.sha256 = b.sha256 THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b ON a.path = b.path""")
def snk_verified(spark: SparkSession, folder: str) -> DataFrame:
    """SNK12: stored documents held against what the results say of them."""
    manifest = table(spark, folder, "case_documents").where("validation_status = 'valid'").select(F.col("sha256").alias("path"), "sha256", "size_bytes")
    found = table(spark, folder, "scrape_results").where("sha256 IS NOT NULL").groupBy(F.col("sha256").alias("path")).agg(F.max("sha256").alias("sha256"), F.max("size_bytes").alias("size_bytes"))
    return runs.verified(manifest, found)


@query("""SELECT result_id, coalesce(status = 'contracts_preserved' AND contract_count > 0 AND pdf_path IS NOT NULL AND ok, false) AS purge FROM scrape_results s LEFT JOIN (SELECT sha256, bool_and(validation_status = 'valid') AS ok FROM case_documents GROUP BY 1) d ON s.sha256 = d.sha256""")
def snk_purgeable(spark: SparkSession, folder: str) -> DataFrame:
    """SNK13: results whose source may go: done, with contracts, there, and all documents valid."""
    r = table(spark, folder, "scrape_results")
    mode = F.when(F.col("contract_count") > 0, "both").otherwise("none")
    releases = r.select("result_id", "sha256", F.when(F.col("status") == "contracts_preserved", "completed").otherwise(F.col("status")).alias("status"), mode.alias("mode"), F.col("pdf_path").isNotNull().alias("source_retained"))
    outputs = table(spark, folder, "case_documents").select("sha256", (F.col("validation_status") == "valid").alias("intact"))
    return runs.purgeable(releases, outputs, "sha256").select("result_id", "purge")


@query("""WITH s AS (SELECT case_id, source_url FROM cases WHERE source_url IS NOT NULL), u AS (SELECT case_id, 'https://x.example/' || substr(source_url, -2) AS url FROM s), o AS (SELECT 'owner' AS case_id, url FROM (SELECT DISTINCT url FROM u WHERE url LIKE '%7'))
SELECT DISTINCT u.url, u.case_id, coalesce(o.case_id, f.claim) AS owner FROM u JOIN (SELECT url, min(case_id) AS claim FROM u GROUP BY url) f ON u.url = f.url LEFT JOIN o ON o.url = u.url WHERE u.case_id <> coalesce(o.case_id, f.claim)""")
def snk_url_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """SNK02: source URLs claimed by more than one case (shortened here, so that some are)."""
    updates = table(spark, folder, "cases").where("source_url IS NOT NULL").select("case_id", F.concat(F.lit("https://x.example/"), F.substring("source_url", -2, 2)).alias("url"))
    owned = updates.select("url").distinct().where(F.col("url").endswith("7")).select(F.lit("owner").alias("case_id"), "url")
    return runs.url_conflicts(updates, owned, "case_id", "url")


@query("SELECT status, count(*) AS n, count(*) FILTER (was = 'running') AS recovered FROM (SELECT CASE WHEN status = 'downloaded' THEN 'running' ELSE status END AS was, CASE WHEN status = 'downloaded' THEN 'pending' ELSE status END AS status FROM scrape_results) GROUP BY status")
def snk_recovered(spark: SparkSession, folder: str) -> DataFrame:
    """SM01: items cut off while running are pending again (downloaded ones stand for them)."""
    r = table(spark, folder, "scrape_results").select(F.when(F.col("status") == "downloaded", "running").otherwise(F.col("status")).alias("status"))
    back = runs.recovered(r.withColumn("was", F.col("status")))
    return back.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("was") == "running").alias("recovered"))


@query("""SELECT process_number, CAST(coalesce(sum(page_count), 0) AS BIGINT) AS pages, CAST(coalesce(sum(contract_count), 0) AS BIGINT) AS contracts, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes, count(*) FILTER (status = 'downloaded') AS downloads, count(*) FILTER (status = 'unchanged') AS unchanged,
count(*) FILTER (is_secret) AS secret, count(*) AS results, round(coalesce(sum(seconds) FILTER (status = 'downloaded'), 0), 3) AS elapsed FROM (SELECT *, epoch_us(try_cast(distribution_at AS TIMESTAMPTZ) - TIMESTAMPTZ '2000-01-01 00:00:00+00') / 1e6 AS seconds FROM scrape_results WHERE regexp_full_match(coalesce(distribution_at, ''), '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z') OR true) GROUP BY process_number""".replace("try_cast(distribution_at AS TIMESTAMPTZ)", "CASE WHEN regexp_full_match(coalesce(distribution_at, ''), '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z') THEN try_cast(distribution_at AS TIMESTAMPTZ) END").replace(" WHERE regexp_full_match(coalesce(distribution_at, ''), '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z') OR true", ""))
def agg_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """AG02, AG03, DT03: seven sums of each process, and seconds since 2000 of finished (downloaded) results."""
    at = F.when(F.col("distribution_at").rlike(r"^\d{4}-\d\d-\d\dT[\d:]{8}Z\z"), F.try_to_timestamp("distribution_at"))
    seconds = (F.unix_micros(at) - F.lit(946_684_800_000_000)) / 1e6
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return table(spark, folder, "scrape_results").groupBy("process_number").agg(
        zero("page_count").alias("pages"), zero("contract_count").alias("contracts"), zero("size_bytes").alias("bytes"), F.count_if(F.col("status") == "downloaded").alias("downloads"), F.count_if(F.col("status") == "unchanged").alias("unchanged"),
        F.count_if("is_secret").alias("secret"), F.count("*").alias("results"), F.round(F.coalesce(F.sum(F.when(F.col("status") == "downloaded", seconds)), F.lit(0.0)), 3).alias("elapsed"))


@query("SELECT process_number, list(result_id ORDER BY result_id) AS results, list(status ORDER BY result_id) AS statuses FROM scrape_results GROUP BY process_number")
def jn_run_history(spark: SparkSession, folder: str) -> DataFrame:
    """JN03: the results of each process in order."""
    grouped = table(spark, folder, "scrape_results").groupBy("process_number").agg(F.sort_array(F.collect_list(F.struct("result_id", "status"))).alias("h"))
    return grouped.select("process_number", F.col("h.result_id").alias("results"), F.col("h.status").alias("statuses"))


@query(f"""WITH eligible AS (SELECT DISTINCT d.document_id, d.case_id, d.sha256 FROM case_documents d JOIN dataset_records r ON d.case_id = r.case_id WHERE d.validation_status = 'valid' AND NOT EXISTS (SELECT 1 FROM scrape_results s WHERE s.sha256 = d.sha256 AND s.status = 'unchanged')),
k AS (SELECT document_id, row_number() OVER (ORDER BY sha256('{SEED}:' || document_id), document_id) AS nth FROM eligible) SELECT document_id, CASE WHEN nth <= 5 THEN 'holdout' ELSE 'development' END AS role FROM k WHERE nth <= 15""")
def pipe_prepared(spark: SparkSession, folder: str) -> DataFrame:
    """PIPE13, JN06, ST02, TK05: documents of recorded cases not exposed before, parted into roles."""
    docs = table(spark, folder, "case_documents").where("validation_status = 'valid'").select("document_id", "case_id", "sha256")
    recorded = table(spark, folder, "dataset_records").select("case_id").where("case_id IS NOT NULL").distinct()
    exposed = table(spark, folder, "scrape_results").where("status = 'unchanged'").select("sha256")
    eligible = docs.join(recorded, "case_id", "left_semi").join(exposed, "sha256", "left_anti")
    return sampling.split(eligible, "document_id", {"holdout": 5, "development": 10}, SEED).select("document_id", "role")


@query(f"""WITH k AS (SELECT document_id, validation_status, row_number() OVER (ORDER BY sha256('{SEED}:' || document_id), document_id) AS nth FROM case_documents)
SELECT count(*) AS corpus, count(*) FILTER (validation_status = 'valid') AS available, count(*) FILTER (validation_status = 'invalid') AS excluded, count(*) FILTER (nth <= 40) AS chosen FROM k""")
def agg_split_summary(spark: SparkSession, folder: str) -> DataFrame:
    """AG20: corpus, available, excluded and chosen documents."""
    docs = table(spark, folder, "case_documents").select("document_id", "validation_status")
    roles = sampling.split(docs, "document_id", {"holdout": 15, "development": 25}, SEED).select("document_id", "role")
    status = F.col("validation_status")
    return sampling.split_summary(docs.join(roles, "document_id", "left"), status == "valid", status == "invalid")


@query()
def smp_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """TK04, WN17, FLT06, UD05: documents picked profile by profile, each preferring sources and languages not yet seen; see the tests for brute force."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", (F.col("n_chars") > 5000).alias("long"), (F.col("lang") != "pt").alias("foreign"), F.lit(True).alias("any")).fillna(False, ["long", "foreign"])
    return sampling.profile_sample(docs.withColumn("key", F.col("doc_id").cast("string")), "key", ["source", "lang"], [("foreign", 4), ("long", 6), ("any", 5)], SEED)


# --- evaluation

_EVAL = """all_pages AS (SELECT DISTINCT source_sha256 AS s, page.page_number AS n FROM page_cache WHERE page.page_number IS NOT NULL),
gold AS (SELECT s, min(n) AS low, max(n) AS high FROM (SELECT s, n, n - row_number() OVER (PARTITION BY s ORDER BY n) AS run FROM all_pages) GROUP BY s, run),
item AS (SELECT s, min(n) AS low, max(n) AS high FROM (SELECT s, n, n - row_number() OVER (PARTITION BY s ORDER BY n) AS run FROM (SELECT DISTINCT source_sha256 AS s, page.page_number AS n FROM page_cache WHERE page.page_number IS NOT NULL AND page.text_method = 'native')) GROUP BY s, run),
verdict AS (SELECT i.s, i.low, CASE WHEN EXISTS (SELECT 1 FROM gold g WHERE g.s = i.s AND g.low = i.low AND g.high = i.high) THEN 'exact' WHEN EXISTS (SELECT 1 FROM gold g WHERE g.s = i.s AND g.low <= i.high AND g.high >= i.low) THEN 'boundary' ELSE 'false' END AS verdict,
i.low % 5 <> 0 AS delivered, CASE WHEN i.low % 7 = 0 THEN 1 ELSE 0 END AS residual, CASE WHEN i.low % 11 = 0 THEN 2 ELSE 0 END AS damaged, i.low % 13 = 0 AS uncertain FROM item i),
flagged AS (SELECT *, residual = 0 AND NOT uncertain AS clean, damaged = 0 AND NOT uncertain AS preserved FROM verdict),
made AS (SELECT s, count(*) AS produced, count(*) FILTER (delivered) AS delivered, count(*) FILTER (verdict = 'exact') AS exact, count(*) FILTER (verdict = 'exact' AND delivered AND clean AND preserved) AS useful, count(*) FILTER (verdict = 'false') AS false_outputs, count(*) FILTER (verdict = 'boundary') AS boundaries,
sum(residual) AS residual_pages, sum(damaged) AS damaged_pages, count(*) FILTER (NOT delivered) AS quarantined, count(*) FILTER (clean) AS clean_outputs, count(*) FILTER (preserved) AS preserved_outputs, count(*) FILTER (uncertain) AS uncertain_outputs FROM flagged GROUP BY s),
scored AS (SELECT g.s AS source_sha256, g.n AS gold, coalesce(produced, 0) AS produced, coalesce(delivered, 0) AS delivered, coalesce(exact, 0) AS exact, coalesce(useful, 0) AS useful, coalesce(useful, 0) AS delivered_good, g.n - coalesce(exact, 0) AS missed, coalesce(false_outputs, 0) AS false_outputs, coalesce(boundaries, 0) AS boundaries,
CAST(coalesce(residual_pages, 0) AS BIGINT) AS residual_pages, CAST(coalesce(damaged_pages, 0) AS BIGINT) AS damaged_pages, coalesce(quarantined, 0) AS quarantined, coalesce(clean_outputs, 0) AS clean_outputs, coalesce(preserved_outputs, 0) AS preserved_outputs, coalesce(uncertain_outputs, 0) AS uncertain_outputs, 0 AS foreign_pages,
CASE WHEN g.s < '4' THEN 'needs_review' WHEN g.s < '6' THEN 'error' ELSE 'completed' END AS status, false AS source_uncertain FROM (SELECT s, count(*) AS n FROM gold GROUP BY s) g LEFT JOIN made m ON g.s = m.s)"""


def _verdicts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    from resma.queries import _occurrences

    gold = _occurrences(spark, folder, None).withColumnRenamed("item", "gold")
    return evaluation.matched(_occurrences(spark, folder, "native"), gold, "source_sha256", "item", "gold"), gold


@query(f"WITH {_EVAL} SELECT s AS source_sha256, CAST(low AS VARCHAR) AS item, verdict FROM verdict")
def eval_matched(spark: SparkSession, folder: str) -> DataFrame:
    """JN10, ST07: runs of native pages held against all runs of pages."""
    return _verdicts(spark, folder)[0].select("source_sha256", "item", "verdict")


@query(f"WITH {_EVAL} SELECT * FROM scored")
def eval_scores(spark: SparkSession, folder: str) -> DataFrame:
    """AG09: the sixteen counters of each source; reviews are made of the number of the first page."""
    verdicts, gold = _verdicts(spark, folder)
    low = F.col("item").cast("long")
    reviews = verdicts.select("source_sha256", "item", (low % 5 != 0).alias("delivered"), F.when(low % 7 == 0, 1).otherwise(0).alias("residual"), F.when(low % 11 == 0, 2).otherwise(0).alias("damaged"), F.lit(0).alias("foreign"), (low % 13 == 0).alias("uncertain"))
    s = F.col("source_sha256")
    sources = gold.select("source_sha256").distinct().select("source_sha256", F.when(s < "4", "needs_review").when(s < "6", "error").otherwise("completed").alias("status"), F.lit(False).alias("uncertain"))
    return evaluation.scores(verdicts, gold, "source_sha256", "item", "gold", reviews, sources)


_RATIO_SQL = ", ".join(f"sum({a}) / nullif(sum({b}), 0) AS {k}" for k, (a, b) in evaluation.RATIOS.items())


@query(f"""WITH {_EVAL} SELECT {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in evaluation.COUNTERS)}, {_RATIO_SQL}, count(*) FILTER (gold > 0) AS positive, count(*) FILTER (gold = 0) AS negative, count(*) FILTER (gold = 0 AND produced > 0) AS false_positive, count(*) FILTER (status = 'needs_review') AS needing_review,
count(*) FILTER (status = 'error') AS error, count(*) FILTER (source_uncertain) AS inconclusive, coalesce(sum(useful) / nullif(sum(gold), 0) >= 0.8 AND sum(delivered_good) / nullif(sum(delivered), 0) >= 0.8, false) AS passed FROM scored""")
def eval_totals(spark: SparkSession, folder: str) -> DataFrame:
    """AG10, AG11, AG12, MA12: sums, ratios with explicit denominators, numbers of sources, and the gate."""
    return evaluation.totals(eval_scores(spark, folder))


# --- pluggable models and scalars


def _by_keyword():
    """A stand-in for a model: the first letter of what a text names, none for short texts."""

    def answer(texts: list[str]) -> list[str | None]:
        return [None if len(t) < 200 else '{"role": "%s", "sure": true}' % ("A" if "DA ADES" in t else "C" if "Ouvidoria" in t else "N") for t in texts]

    return answer


@query("""SELECT page_id, CASE WHEN length(t) >= 200 THEN CASE WHEN contains(t, 'DA ADES') THEN 'A' WHEN contains(t, 'Ouvidoria') THEN 'C' ELSE 'N' END END AS role FROM (SELECT page_id, page.text AS t FROM page_cache WHERE page.text <> '')""")
def ud_classified(spark: SparkSession, folder: str) -> DataFrame:
    """UD01-UD03, PIPE03, FLT23: pages classified by a pluggable model; equal texts are asked once."""
    p = table(spark, folder, "page_cache").select("page_id", F.col("page.text").alias("t")).where("t <> ''").withColumn("key", models.request_key(F.lit("role"), F.col("t")))
    cache = p.where("false").select("key", F.col("t").alias("answer"))
    answers = models.asked(p, "key", "t", _by_keyword, cache)
    checked = models.checked_answer(F.col("answer"), "struct<role: string, sure: boolean>", lambda a: a["role"].isin("A", "C", "N") & a["sure"].isNotNull())
    return p.select("page_id", "key").join(answers.select("key", checked.alias("a")), "key", "left").select("page_id", F.col("a.role").alias("role"))


@query("SELECT page_id, count(*) AS n, round(min(x0), 4) AS x0, round(max(x1), 4) AS x1 FROM (SELECT page_id, unnest(page.words, recursive := true) FROM page_cache WHERE page.words IS NOT NULL) WHERE trim(text) <> '' AND x1 > x0 AND y1 > y0 GROUP BY page_id")
def src_recognised_words(spark: SparkSession, folder: str) -> DataFrame:
    """SRC08: words read back from tab-separated results of a recogniser, made of the cached words."""
    p = table(spark, folder, "page_cache").where("page.words IS NOT NULL").select("page_id", "page.words")
    cell = lambda w: F.concat_ws("\t", F.lit("5"), *[F.lit("1")] * 5, w["x0"].cast("string"), w["y0"].cast("string"), (w["x1"] - w["x0"]).cast("string"), (w["y1"] - w["y0"]).cast("string"), F.lit("95"), w["text"])
    made = p.select("page_id", F.concat(F.lit("level\tpage_num\n4\t1\n"), F.array_join(F.transform("words", cell), "\n")).alias("tsv"))
    w = models.recognised_words(made, "page_id", "tsv")
    return w.groupBy("page_id").agg(F.count("*").alias("n"), F.round(F.min("x0"), 4).alias("x0"), F.round(F.max("x1"), 4).alias("x1"))


@query(r"""SELECT result_id, CASE WHEN h % 4 = 0 THEN CAST(h % 90 AS DOUBLE) ELSE [5.0, 15.0][least(greatest(h % 5, 1), 2)] + (h % 3) END AS wait, coalesce(h % 4 = 0 AND h % 90 > 60, false) AS pause FROM (SELECT result_id, result_id AS h FROM scrape_results)""")
def ma_retry(spark: SparkSession, folder: str) -> DataFrame:
    """MA10, UD04: waits before a retry, with jitter, and whether the batch pauses; attempts and headers are made of the id."""
    h = F.col("result_id")
    r = numbers.retry((h % 5).cast("int"), F.when(h % 4 == 0, (h % 90).cast("string")), F.lit("2026-01-01").cast("timestamp"), (h % 3).cast("double"))
    return table(spark, folder, "scrape_results").select("result_id", r.alias("r")).select("result_id", "r.wait", "r.pause")


@query("SELECT document_id, CAST(greatest(1, least(12, floor(4096 / (512 + ceil(size_bytes / 1048576))))) AS INT) AS workers FROM case_documents")
def ma_workers(spark: SparkSession, folder: str) -> DataFrame:
    """MA11: workers that fit into 4,096 MB for each document."""
    return table(spark, folder, "case_documents").select("document_id", numbers.worker_limit(F.lit(12), F.lit(4096), F.col("size_bytes")).alias("workers"))


@query("""SELECT case_id, sha256('{' || list_aggregate(list_filter(['"a_subject":' || to_json(subject), '"b_secret":' || is_secret, '"c_id":' || to_json(projudi_internal_id)], lambda x: x IS NOT NULL), 'string_agg', ',') || '}') AS digest FROM cases WHERE NOT regexp_matches(coalesce(subject, ''), '[/\\\\]') AND (subject IS NOT NULL OR is_secret IS NOT NULL OR projudi_internal_id IS NOT NULL)""")
def ma_digest(spark: SparkSession, folder: str) -> DataFrame:
    """MA02, JS01: the hash of members in order of name."""
    some = F.coalesce("subject", F.col("is_secret").cast("string"), "projudi_internal_id").isNotNull()
    c = table(spark, folder, "cases").where(~F.coalesce("subject", F.lit("")).rlike(r"[/\\]") & some)
    return c.select("case_id", numbers.canonical_digest(c_id=F.col("projudi_internal_id"), a_subject=F.col("subject"), b_secret=F.col("is_secret")).alias("digest"))


@query(r"""SELECT result_id, strftime(m AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS utc, epoch_us(m) - epoch_us(TIMESTAMPTZ '2026-01-01 00:00:00+00') AS micros FROM
(SELECT result_id, CAST(retrieved_at AS TIMESTAMPTZ) AS m FROM scrape_results WHERE regexp_full_match(retrieved_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})'))""")
def dt_iso(spark: SparkSession, folder: str) -> DataFrame:
    """DT02-DT04: ISO moments with an offset in UTC, and their distance from 2026 in microseconds."""
    iso = F.col("retrieved_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d{1,6})?(Z|[+-]\d\d:\d\d)\z")
    at = F.try_to_timestamp("retrieved_at")
    r = table(spark, folder, "scrape_results").where(iso).select("result_id", at.alias("at"))
    return r.select("result_id", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"), (F.unix_micros("at") - F.lit(1_767_225_600_000_000)).alias("micros"))


@query(r"""SELECT case_id, regexp_full_match(coalesce(projudi_internal_id, ''), '[0-9][0-9./-]{6,}') AS long_id, CASE WHEN is_secret IS NULL THEN 'inconcluso' ELSE printf('%.1f%%', is_secret * 100.0) END AS share, regexp_extract(subject, '^[^ ]+', 0) || '.pdf' AS name,
CASE WHEN contains(lower(subject), 'banc') THEN 'bank' WHEN contains(lower(subject), 'consumo') THEN 'consumer' ELSE 'other' END AS family, 'https://projudi.tribunal.example/projudi/listagens/DadosProcesso?numeroProcesso=' || url_encode(projudi_internal_id) AS url FROM cases""")
def str_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """STR06, STR13, STR14, STR17, STR18: long identifiers, shares as text, file names of headers, first matching family, canonical URLs."""
    header = F.concat(F.lit('attachment; filename="/tmp/'), F.regexp_extract("subject", "^[^ ]+", 0), F.lit('.pdf"'))
    family = text.first_match(F.lower("subject"), {"bank": "banc", "consumer": "consumo"}, "other")
    return table(spark, folder, "cases").select(
        "case_id", text.long_identifier(F.col("projudi_internal_id")).alias("long_id"), text.percentage(F.col("is_secret").cast("double")).alias("share"), text.disposition_name(header).alias("name"),
        family.alias("family"), text.canonical_url(HOST, CASE, "numeroProcesso", F.col("projudi_internal_id")).alias("url"))


@query(r"""SELECT page_id, count(DISTINCT v) FILTER (contains(after, v)) AS residual FROM (SELECT page_id, t AS whole, substr(t, 1, length(t) // 2) AS before, substr(t, length(t) // 2 + 1) AS after, unnest(regexp_extract_all(substr(t, 1, length(t) // 2), '[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}')) AS v FROM (SELECT page_id, page.text AS t FROM page_cache WHERE page.text <> '')) GROUP BY page_id""")
def agg_residual(spark: SparkSession, folder: str) -> DataFrame:
    """AG21, FLT20: tax numbers of the first half of a page that its second half still holds."""
    p = table(spark, folder, "page_cache").select("page_id", F.col("page.text").alias("t")).where("t <> ''")
    half = F.floor(F.length("t") / 2).cast("int")
    both = p.select("page_id", F.substring(F.col("t"), F.lit(1), half).alias("before"), F.substring(F.col("t"), half + 1, F.length("t")).alias("after"))
    found = F.array_distinct(F.regexp_extract_all("before", F.lit(r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"), F.lit(0)))
    return both.where(F.size(found) > 0).select("page_id", F.size(F.filter(found, lambda v: F.col("after").contains(v))).cast("long").alias("residual"))


@query("""SELECT page_id, len(list_filter(u, lambda r: ((r[3] - r[1]) * (r[4] - r[2]) BETWEEN 0.03 AND 0.97 OR r = [0.0, 0.0, 1.0, 1.0]) AND r[1] >= 0 AND r[2] >= 0 AND r[3] <= 1 AND r[4] <= 1 AND r[1] < r[3] AND r[2] < r[4])) > 0 AS shown, len(list_filter(u, lambda r: (r[3] - r[1]) * (r[4] - r[2]) > 0.0001 AND (r[3] - r[1]) * (r[4] - r[2]) < 0.15 AND r[3] - r[1] < 0.6 AND r[4] - r[2] < 0.45 AND r[1] >= 0 AND r[2] >= 0 AND r[3] <= 1 AND r[4] <= 1 AND r[1] < r[3] AND r[2] < r[4])) AS pictures
FROM (SELECT page_id, list_transform(page.image_rects, lambda r: [r[1] / page.width, r[2] / page.height, r[3] / page.width, r[4] / page.height]) AS u FROM page_cache WHERE len(page.image_rects) > 0)""")
def geo_regions(spark: SparkSession, folder: str) -> DataFrame:
    """FLT18, FLT19: whether a page has regions to show, and its pictures."""
    p = table(spark, folder, "page_cache").where(F.size("page.image_rects") > 0).select("page_id", "page.image_rects", "page.width", "page.height")
    unit = F.transform("image_rects", lambda r: geometry.box(r[0] / F.col("width"), r[1] / F.col("height"), r[2] / F.col("width"), r[3] / F.col("height")))
    return p.select("page_id", (F.size(geometry.admitted(unit)) > 0).alias("shown"), F.size(geometry.graphics(unit)).cast("long").alias("pictures"))


@query("""SELECT page_id, CAST(floor(min(x0) * 1000) AS INT) AS px0, CAST(ceil(max(x1) * 1000) AS INT) AS px1, count(*) FILTER ((x0 + x1) / 2 BETWEEN 0.0 AND 0.5 AND (y0 + y1) / 2 BETWEEN 0.0 AND 0.5) AS inside FROM (SELECT page_id, greatest(0, x0 / w) AS x0, greatest(0, y0 / h) AS y0, least(1, x1 / w) AS x1, least(1, y1 / h) AS y1 FROM
(SELECT page_id, page.width AS w, page.height AS h, unnest(page.words, recursive := true) FROM page_cache WHERE page.words IS NOT NULL AND page.rotation = 0)) WHERE x1 > x0 AND y1 > y0 GROUP BY page_id""")
def geo_cropped(spark: SparkSession, folder: str) -> DataFrame:
    """MA07, FLT17: the words of the upper left quarter, and the pixels of all words."""
    p = table(spark, folder, "page_cache").where("page.words IS NOT NULL AND page.rotation = 0")
    w = p.select("page_id", geometry.unit_words(F.col("page.words"), F.col("page.width"), F.col("page.height"), F.col("page.rotation")).alias("w")).where(F.size("w") > 0)
    low, high = F.array_min(F.transform("w", lambda x: x["x0"])), F.array_max(F.transform("w", lambda x: x["x1"]))
    box = geometry.pixel_box(geometry.box(low, F.lit(0.0), high, F.lit(1.0)), 1000, 1000)
    quarter = geometry.box(F.lit(0.0), F.lit(0.0), F.lit(0.5), F.lit(0.5))
    return w.select("page_id", box["x0"].alias("px0"), box["x1"].alias("px1"), F.size(geometry.cropped(F.col("w"), quarter)).cast("long").alias("inside"))


@query("""SELECT fingerprint, min(source_sha256) AS first_source, count(*) AS copies, list_sort(list(source_sha256)) AS sources FROM (SELECT source_sha256, configuration_sha256, sha256(string_agg(coalesce(t, ''), chr(31) ORDER BY n)) AS fingerprint FROM
(SELECT source_sha256, configuration_sha256, page.page_number AS n, max(page.text) AS t FROM page_cache WHERE page.page_number IS NOT NULL AND configuration_sha256 IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY fingerprint""")
def dup_page_lists(spark: SparkSession, folder: str) -> DataFrame:
    """AG17, AG18: documents of equal ordered pages: their first source, copies and all occurrences."""
    one = table(spark, folder, "page_cache").where("page.page_number IS NOT NULL AND configuration_sha256 IS NOT NULL").groupBy("source_sha256", "configuration_sha256", F.col("page.page_number").alias("n")).agg(F.max("page.text").alias("t"))
    return copies.equal_lists(one, ["source_sha256", "configuration_sha256"], "n", "t", "source_sha256")


@query("SELECT page_id, CAST(c[1] AS INT) AS page, CAST(c[2] AS INT) AS of FROM (SELECT page_id, list_extract(list_filter(list_transform(regexp_extract_all(string_agg(text, ' ' ORDER BY i), '\\b[0-9]{1,2}\\s*(?:/|de)\\s*[0-9]{1,2}\\b'), lambda m: [CAST(regexp_extract(m, '^([0-9]+)', 1) AS INT), CAST(regexp_extract(m, '([0-9]+)$', 1) AS INT)]), lambda p: p[1] BETWEEN 1 AND 60 AND p[2] BETWEEN 1 AND 60), -1) AS c FROM (SELECT page_id, i, page.words[i].y0 / page.height AS y, page.words[i].text AS text FROM (SELECT *, unnest(range(1, len(page.words) + 1)) AS i FROM page_cache WHERE page.words IS NOT NULL AND page.rotation = 0)) WHERE y >= 0.0 AND y < 0.956 GROUP BY page_id) WHERE c IS NOT NULL")
def str_band_counter(spark: SparkSession, folder: str) -> DataFrame:
    """STR08: the printed counter within a band of heights (here down to 0.956; the test tables hold first lines only)."""
    p = table(spark, folder, "page_cache").where("page.words IS NOT NULL AND page.rotation = 0")
    words = geometry.unit_words(F.col("page.words"), F.col("page.width"), F.col("page.height"), F.col("page.rotation"))
    c = text.printed_counter(geometry.text_between(words, 0.0, 0.956))
    return p.select("page_id", c.alias("c")).where("c IS NOT NULL").select("page_id", "c.page", "c.of")


__all__ = ["QUERIES", "SQL"]
