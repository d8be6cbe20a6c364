"""Queries of the engine's own operators over the project's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resma.functions import geometry, numbers, text
from resma.operators import case_pages, catalog, copies, evaluation, layout, sampling, sequences
from resma.sources import jsonl
from resma.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_NORMAL = f"trim(regexp_replace(translate(strip_accents(lower({{x}})), 'ºª', 'oa'), '\\s+', ' ', 'g'))"


# --- text


@query(f"SELECT doc_id, length({_NORMAL.format(x='text')}) AS size, sha256({_NORMAL.format(x='text')}) AS normal FROM documents")
def str_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """STR01-STR03: texts without marks, case and uneven white space."""
    n = text.normalized(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", n.alias("n")).select("doc_id", F.length("n").cast("long").alias("size"), F.sha2("n", 256).alias("normal"))


#: Kinds of pleading by words of their text.
PLEADINGS = {"appeal": r"\brecurso\b", "evidence": r"\b(?:documento|prova|laudo)s?\b", "hearing": r"\baudiencia\b", "ruling": r"\b(?:sentenca|acordao|decisao)\b"}


@query(f"SELECT doc_id, name FROM (SELECT doc_id, {_NORMAL.format(x='text')} AS n FROM documents) d, (VALUES " + ", ".join(f"('{n}', '{p}')" for n, p in PLEADINGS.items()) + ") e(name, pattern) WHERE regexp_matches(n, pattern)")
def flt_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Which of several named patterns a text holds."""
    docs = table(spark, folder, "documents").select("doc_id", text.normalized(F.col("text")).alias("n"))
    return docs.select("doc_id", F.explode(text.evidence(F.col("n"), PLEADINGS)).alias("name"))


@query("""SELECT page_id, fault FROM (SELECT page_id, unnest(list_filter([CASE WHEN length(t) - length(replace(t, chr(65533), '')) > greatest(10.0, length(t) * 0.05) THEN 'replacement_characters' END, CASE WHEN length(t) - length(regexp_replace(t, '[\\p{Co}\\p{Cs}]', '', 'g')) > greatest(5.0, length(t) * 0.02) THEN 'unmapped_characters' END], lambda x: x IS NOT NULL)) AS fault
FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN page.text || repeat(chr(65533), 200) WHEN page_id % 3 = 1 THEN page.text || repeat(chr(57345), 60) ELSE page.text END AS t FROM page_cache WHERE page.text <> ''))""")
def flt_text_faults(spark: SparkSession, folder: str) -> DataFrame:
    """FLT08: signs of badly extracted text; odd characters are added to two thirds of the pages, as the tables hold none."""
    t = F.col("page.text")
    odd = F.when(F.col("page_id") % 3 == 0, F.concat(t, F.lit("\ufffd" * 200))).when(F.col("page_id") % 3 == 1, F.concat(t, F.lit("\ue001" * 60))).otherwise(t)
    pages = table(spark, folder, "page_cache").where("page.text <> ''").select("page_id", text.text_faults(odd).alias("faults"))
    return pages.select("page_id", F.explode("faults").alias("fault"))


@query(
    "SELECT document_id, trim(regexp_replace(" + _NORMAL.format(x="original_filename") + ", '[^a-z0-9]+', ' ', 'g')) AS words FROM case_documents"
)
def str_title_words(spark: SparkSession, folder: str) -> DataFrame:
    """STR04: file names as words."""
    return table(spark, folder, "case_documents").select("document_id", text.title_words(F.col("original_filename")).alias("words"))


@query(
    "SELECT doc_id, len(list_distinct(regexp_extract_all(" + _NORMAL.format(x="text") + ", '[a-z]{4,}|[0-9]{5,}'))) AS n_tokens FROM documents"
)
def str_token_sets(spark: SparkSession, folder: str) -> DataFrame:
    """STR09: size of each document's set of tokens."""
    return table(spark, folder, "documents").select("doc_id", F.size(text.tokens(text.normalized(F.col("text")))).cast("long").alias("n_tokens"))


@query(r"""
SELECT page_id, CAST(c[1] AS INT) AS page, CAST(c[2] AS INT) AS of FROM (
  SELECT page_id, list_extract(list_filter(list_transform(regexp_extract_all(page.text, '\b[0-9]{1,2}\s*(?:/|de)\s*[0-9]{1,2}\b'),
    lambda m: [CAST(regexp_extract(m, '^([0-9]+)', 1) AS INT), CAST(regexp_extract(m, '([0-9]+)$', 1) AS INT)]),
    lambda p: p[1] BETWEEN 1 AND 60 AND p[2] BETWEEN 1 AND 60), -1) AS c FROM page_cache)
WHERE c IS NOT NULL""")
def str_printed_counter(spark: SparkSession, folder: str) -> DataFrame:
    """STR08: the last printed page counter of each page."""
    pages = table(spark, folder, "page_cache").select("page_id", text.printed_counter(F.col("page.text")).alias("c"))
    return pages.where("c IS NOT NULL").select("page_id", "c.page", "c.of")


# --- numbers


@query(r"""
SELECT case_id, CASE WHEN regexp_full_match(process_number, '[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}')
  AND 98 - CAST(substr(d, 1, 7) || substr(d, 10, 11) || '00' AS HUGEINT) % 97 = CAST(substr(d, 8, 2) AS INT) THEN d END AS digits
FROM (SELECT case_id, process_number, regexp_replace(process_number, '[^0-9]', '', 'g') AS d FROM cases)""")
def flt_process_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """FLT02, MA01: digits of the process numbers with right check digits."""
    return table(spark, folder, "cases").select("case_id", numbers.process_digits(F.col("process_number")).alias("digits"))


@query(r"""
WITH found AS (SELECT page_id, unnest(regexp_extract_all(page.text, '[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}')) AS v FROM page_cache),
digits AS (SELECT page_id, v, list_transform(string_split(regexp_replace(v, '[^0-9]', '', 'g'), ''), lambda c: CAST(c AS INT)) AS d FROM found)
SELECT page_id, count(*) AS numbers, count(*) FILTER (len(list_distinct(d)) > 1
  AND (list_sum(list_transform(d[1:9], lambda x, i: x * (11 - i))) * 10) % 11 % 10 = d[10]
  AND (list_sum(list_transform(d[1:10], lambda x, i: x * (12 - i))) * 10) % 11 % 10 = d[11]) AS valid
FROM digits GROUP BY page_id""")
def str_tax_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """STR11: tax numbers per page and how many have right check digits."""
    found = table(spark, folder, "page_cache").select("page_id", F.explode(F.regexp_extract_all("page.text", F.lit(r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"), F.lit(0))).alias("v"))
    return found.groupBy("page_id").agg(F.count("*").alias("numbers"), F.count_if(numbers.valid_cpf(F.col("v"))).alias("valid"))


@query(r"""
SELECT case_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id
FROM (SELECT case_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('projudi:' || process_number)) AS h FROM cases)""")
def ma_name_uuid(spark: SparkSession, folder: str) -> DataFrame:
    """MA04: name-based UUIDs of cases."""
    return table(spark, folder, "cases").select("case_id", numbers.uuid5(F.concat(F.lit("projudi:"), "process_number")).alias("id"))


@query("SELECT dataset_id, sha256(sha256 || ':' || metadata_sha256) AS fingerprint FROM datasets")
def ma_dataset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """MA05: one hash over a file and its sidecar."""
    return table(spark, folder, "datasets").select("dataset_id", F.sha2(F.concat_ws(":", "sha256", "metadata_sha256"), 256).alias("fingerprint"))


@query(r"""
SELECT d.document_id, substr(g, 10, 4) || '/' || g || '/' || process_number || '__' || regexp_replace(substr(d.retrieved_at, 1, 19), '[-:]', '', 'g') || '__' || substr(d.sha256, 1, 12) || '.pdf' AS path
FROM case_documents d JOIN (SELECT case_id, process_number, regexp_replace(process_number, '[^0-9]', '', 'g') AS g FROM cases) c ON d.case_id = c.case_id""")
def snk_document_path(spark: SparkSession, folder: str) -> DataFrame:
    """SNK08: the content-addressed place of each document."""
    docs, cases = table(spark, folder, "case_documents"), table(spark, folder, "cases").select("case_id", "process_number")
    return docs.join(cases, "case_id").select("document_id", numbers.document_path(F.col("process_number"), F.col("retrieved_at"), F.col("sha256")).alias("path"))


@query(r"""
SELECT case_id, regexp_extract(source_url, '^([a-z]+)://', 1) AS scheme, regexp_extract(source_url, '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_extract(source_url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path, CASE WHEN right(source_url, 1) = '3' THEN 'host' WHEN right(source_url, 1) = '5' THEN 'fragment' WHEN right(source_url, 1) = '7' THEN 'scheme'
  WHEN NOT regexp_matches(source_url, '^https://projudi\.tribunal\.example(:443)?/projudi/listagens/DadosProcesso\?numeroProcesso=[A-Za-z0-9_-]{1,128}$') THEN 'parameters' END AS fault FROM cases WHERE source_url IS NOT NULL""")
def flt_urls(spark: SparkSession, folder: str) -> DataFrame:
    """FLT03: parts of the source URLs and why one is not allowed; by their last digit some are given another host or scheme or a fragment first."""
    u, last = F.col("source_url"), F.right("source_url", F.lit(1))
    spoilt = F.when(last == "3", F.replace(u, F.lit("tribunal.example"), F.lit("tribunal.example.evil.test"))).when(last == "5", F.concat(u, F.lit("#x"))).when(last == "7", F.replace(u, F.lit("https:"), F.lit("http:"))).otherwise(u)
    fault = text.url_fault(spoilt, "projudi.tribunal.example", path="/projudi/listagens/DadosProcesso", parameter="numeroProcesso")
    cases = table(spark, folder, "cases").where(u.isNotNull())
    return cases.select("case_id", F.parse_url(u, F.lit("PROTOCOL")).alias("scheme"), F.parse_url(u, F.lit("HOST")).alias("host"), F.parse_url(u, F.lit("PATH")).alias("path"), fault.alias("fault"))


# --- samples

SEED = 20260920
_STRATA = "SELECT doc_id, lang, source, CAST(to_json([lang, source]) AS VARCHAR) AS stratum FROM documents"
_QUOTAS = f"""
strata AS (SELECT stratum, count(*) AS size FROM d GROUP BY stratum), t AS (SELECT count(*) AS k, sum(size) AS rows FROM strata),
shares AS (SELECT stratum, size, least(100, rows) - k AS seats, CASE WHEN rows > k THEN CAST((least(100, rows) - k) * (size - 1) AS BIGINT) // CAST(rows - k AS BIGINT) ELSE 0 END AS share,
  CASE WHEN rows > k THEN CAST((least(100, rows) - k) * (size - 1) AS BIGINT) % CAST(rows - k AS BIGINT) ELSE 0 END AS rest FROM strata, t),
quotas AS (SELECT stratum, size, CAST(CASE WHEN seats >= 0 THEN 1 + share + CASE WHEN row_number() OVER (ORDER BY rest DESC, sha256('{SEED}:' || stratum)) <= seats - sum(share) OVER () THEN 1 ELSE 0 END END AS BIGINT) AS quota FROM shares)"""


def _stratified(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "lang", "source", sampling.stratum("lang", "source").alias("stratum"))


@query(f"SELECT case_id, sha256('{SEED}:' || process_number) AS rank FROM cases ORDER BY rank, case_id LIMIT 50")
def smp_uniform(spark: SparkSession, folder: str) -> DataFrame:
    """TK02, MA03: a seeded uniform sample."""
    cases = table(spark, folder, "cases").select("case_id", "process_number")
    return cases.withColumn("rank", numbers.seeded_rank(SEED, F.col("process_number"))).orderBy("rank", "case_id").limit(50).select("case_id", "rank")


@query(f"WITH d AS ({_STRATA}), {_QUOTAS} SELECT stratum, size, quota FROM quotas")
def smp_quotas(spark: SparkSession, folder: str) -> DataFrame:
    """WN15, AG06: seats of each stratum by largest remainder."""
    return sampling.quotas(_stratified(spark, folder).groupBy("stratum").agg(F.count("*").alias("size")), 100, SEED)


@query(f"""WITH d AS ({_STRATA}), {_QUOTAS} SELECT doc_id, d.stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256('{SEED}:' || doc_id), doc_id) AS nth FROM d) d
JOIN quotas q ON d.stratum = q.stratum WHERE nth <= quota""")
def smp_by_quota(spark: SparkSession, folder: str) -> DataFrame:
    """TK03: every stratum by its quota in seeded order."""
    docs = _stratified(spark, folder).withColumn("key", F.col("doc_id").cast("string"))
    return sampling.quota_sample(docs, "key", "stratum", 100, SEED).select("doc_id", "stratum")


@query()
def smp_covering(spark: SparkSession, folder: str) -> DataFrame:
    """WN16: a quota sample over languages and years that spreads over sources; held against brute force in the tests."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", F.year("collected_at").alias("year"))
    docs = docs.withColumn("stratum", sampling.stratum("lang", "year")).withColumn("key", F.col("doc_id").cast("string"))
    return sampling.covering_sample(docs, "key", "stratum", "source", 100, SEED).select("doc_id", "stratum", "source")


@query(f"""WITH d AS ({_STRATA}), {_QUOTAS}, picked AS (SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256('{SEED}:' || doc_id), doc_id) AS nth FROM d) x JOIN quotas q ON x.stratum = q.stratum WHERE nth <= quota)
SELECT dimension, value, count(*) AS population, count(p.doc_id) AS selected FROM (SELECT doc_id, 'lang' AS dimension, coalesce(lang, 'null') AS value FROM d UNION ALL SELECT doc_id, 'source', coalesce(source, 'null') FROM d UNION ALL SELECT doc_id, 'stratum', CAST(stratum AS VARCHAR) FROM d) v
LEFT JOIN picked p ON v.doc_id = p.doc_id GROUP BY dimension, value""")
def smp_report(spark: SparkSession, folder: str) -> DataFrame:
    """AG07, AG08: population and sample by the values of each dimension."""
    docs = _stratified(spark, folder).withColumn("key", F.col("doc_id").cast("string"))
    return sampling.sampling_report(docs, sampling.quota_sample(docs, "key", "stratum", 100, SEED), "key", ["lang", "source", "stratum"])


@query(f"""SELECT document_id, CASE WHEN nth <= 25 THEN 'holdout' ELSE 'development' END AS role FROM (SELECT document_id, row_number() OVER (ORDER BY sha256('{SEED}:' || document_id), document_id) AS nth FROM case_documents WHERE validation_status = 'valid') WHERE nth <= 55""")
def smp_split(spark: SparkSession, folder: str) -> DataFrame:
    """TK05, AG20, ST03: disjoint roles in seeded order."""
    valid = table(spark, folder, "case_documents").where("validation_status = 'valid'").select("document_id")
    return sampling.split(valid, "document_id", {"holdout": 25, "development": 30}, SEED).select("document_id", "role")


# --- catalog


@query("SELECT case_id, document_id, retrieved_at FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY retrieved_at DESC, document_id) AS nth FROM case_documents WHERE validation_status = 'valid') WHERE nth = 1")
def cat_latest_document(spark: SparkSession, folder: str) -> DataFrame:
    """JN04, WN01: the newest valid document of each case."""
    valid = table(spark, folder, "case_documents").where("validation_status = 'valid'").select("case_id", "document_id", "retrieved_at")
    return catalog.latest(valid, ["case_id"], [F.desc("retrieved_at"), F.asc("document_id")])


@query("SELECT s.result_id, d.document_id, c.process_number FROM scrape_results s JOIN case_documents d ON s.sha256 = d.sha256 JOIN cases c ON d.case_id = c.case_id WHERE d.validation_status = 'valid'")
def cat_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    """JN05: results with their valid documents by hash."""
    docs = table(spark, folder, "case_documents").where("validation_status = 'valid'").select("document_id", "case_id", "sha256")
    cases = table(spark, folder, "cases").select("case_id", "process_number")
    results = table(spark, folder, "scrape_results").select("result_id", "sha256")
    return results.join(docs, "sha256").join(cases, "case_id").select("result_id", "document_id", "process_number")


@query("SELECT DISTINCT r.dataset_id, c.case_id, d.document_id FROM dataset_records r JOIN cases c ON r.case_id = c.case_id JOIN case_documents d ON d.case_id = c.case_id")
def cat_dataset_documents(spark: SparkSession, folder: str) -> DataFrame:
    """JN01, JN02, JN06: the documents of each file's cases."""
    records = table(spark, folder, "dataset_records").select("dataset_id", "case_id").where("case_id IS NOT NULL").distinct()
    cases = table(spark, folder, "cases").select("case_id")
    docs = table(spark, folder, "case_documents").select("case_id", "document_id")
    return records.join(cases, "case_id").join(docs, "case_id").select("dataset_id", "case_id", "document_id").distinct()


@query("SELECT result_id, pdf_path FROM scrape_results s WHERE pdf_path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM case_documents d WHERE d.sha256 = s.sha256 AND d.page_count > 20)")
def cat_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """JN08: published files without a document of more than 20 pages (every file has some document)."""
    docs = table(spark, folder, "case_documents").where("page_count > 20").select("sha256")
    return table(spark, folder, "scrape_results").where("pdf_path IS NOT NULL").join(docs, "sha256", "left_anti").select("result_id", "pdf_path")


@query("SELECT DISTINCT c.case_id FROM cases c WHERE NOT EXISTS (SELECT 1 FROM case_documents d WHERE d.case_id = c.case_id) AND NOT EXISTS (SELECT 1 FROM scrape_results s WHERE s.process_number = c.process_number)")
def cat_never_seen(spark: SparkSession, folder: str) -> DataFrame:
    """JN09, ST02, ST06: cases in none of the exposed sets."""
    cases = table(spark, folder, "cases").select("case_id", "process_number")
    seen = table(spark, folder, "case_documents").select("case_id").join(cases, "case_id").select("case_id")
    scraped = table(spark, folder, "scrape_results").select("process_number").join(cases, "process_number").select("case_id")
    return cases.select("case_id").join(seen.union(scraped).distinct(), "case_id", "left_anti")


@query("SELECT DISTINCT ON (process_number) process_number, subject FROM scrape_results s WHERE process_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cases c WHERE c.process_number = s.process_number AND c.is_secret = 0) ORDER BY process_number, subject NULLS LAST")
def snk_insert_absent(spark: SparkSession, folder: str) -> DataFrame:
    """SNK01: what an import would insert into the public cases."""
    new = table(spark, folder, "scrape_results").where("process_number IS NOT NULL").select("process_number", "subject")
    return catalog.absent(new, table(spark, folder, "cases").where("is_secret = 0").select("process_number"), ["process_number"])


@query("""WITH u AS (SELECT process_number, subject, distribution_at FROM (SELECT *, row_number() OVER (PARTITION BY process_number ORDER BY result_id DESC) AS nth FROM scrape_results WHERE process_number IS NOT NULL) WHERE nth = 1)
SELECT coalesce(c.process_number, u.process_number) AS process_number, CASE WHEN u.process_number IS NOT NULL THEN u.subject ELSE c.subject END AS subject, coalesce(u.distribution_at, c.distribution_at) AS distribution_at,
CASE WHEN c.process_number IS NULL THEN 'inserted' WHEN u.process_number IS NOT NULL THEN 'updated' ELSE 'kept' END AS upsert FROM cases c FULL JOIN u ON c.process_number = u.process_number""")
def snk_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """SNK02: cases with the newest results put over them."""
    results = table(spark, folder, "scrape_results").where("process_number IS NOT NULL").select("process_number", "subject", "distribution_at", "result_id")
    newest = catalog.latest(results, ["process_number"], [F.desc("result_id")]).drop("result_id")
    return catalog.upserted(table(spark, folder, "cases").select("process_number", "subject", "distribution_at"), newest, ["process_number"], ["distribution_at"])


@query("SELECT coalesce(status, 'null') AS status, count(*) AS n FROM scrape_results GROUP BY status UNION ALL SELECT 'total', count(*) FROM scrape_results")
def agg_status(spark: SparkSession, folder: str) -> DataFrame:
    """AG01, AG19: results by status with their total."""
    return catalog.status_counts(table(spark, folder, "scrape_results"), "status")


@query("""SELECT process_number, count(*) AS runs, count(DISTINCT run_id) AS distinct_runs, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes, CAST(coalesce(sum(page_count), 0) AS BIGINT) AS pages, max(size_bytes) AS largest,
CASE WHEN count(page_count) = count(*) THEN CAST(sum(page_count) AS BIGINT) END AS pages_if_all FROM scrape_results GROUP BY process_number""")
def agg_runs(spark: SparkSession, folder: str) -> DataFrame:
    """AG02, AG03, AG13, JN03: sums over the runs of each process."""
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return table(spark, folder, "scrape_results").groupBy("process_number").agg(
        F.count("*").alias("runs"), F.countDistinct("run_id").alias("distinct_runs"), zero("size_bytes").alias("bytes"), zero("page_count").alias("pages"), F.max("size_bytes").alias("largest"),
        evaluation.sum_if_all(F.col("page_count")).alias("pages_if_all"),
    )


@query("""SELECT d.dataset_id, try_cast(coalesce(json_extract_string(metadata_json, '$.total_registros'), json_extract_string(metadata_json, '$.total_linhas')) AS BIGINT) AS stated, coalesce(n, 0) AS lines,
coalesce(try_cast(coalesce(json_extract_string(metadata_json, '$.total_registros'), json_extract_string(metadata_json, '$.total_linhas')) AS BIGINT) = coalesce(n, 0), false) AS agrees
FROM datasets d LEFT JOIN (SELECT dataset_id, count(*) AS n FROM dataset_records GROUP BY dataset_id) r ON d.dataset_id = r.dataset_id""")
def agg_reconciled(spark: SparkSession, folder: str) -> DataFrame:
    """AG05, SRC03: stated against found numbers of lines."""
    return jsonl.reconciled(table(spark, folder, "datasets").select("dataset_id", "metadata_json"), table(spark, folder, "dataset_records").select("dataset_id"))


# --- sequences


@query("""SELECT source_sha256, min(n) AS start, max(n) AS stop, count(*) AS size FROM (SELECT source_sha256, n, n - row_number() OVER (PARTITION BY source_sha256 ORDER BY n) AS run
FROM (SELECT DISTINCT source_sha256, page.page_number AS n FROM page_cache WHERE page.page_number IS NOT NULL)) GROUP BY source_sha256, run""")
def win_islands(spark: SparkSession, folder: str) -> DataFrame:
    """WN04, WN08: runs of consecutive cached pages."""
    return sequences.islands(table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("n")), ["source_sha256"], "n")


@query("""SELECT source_sha256, min(n) AS start, max(n) AS stop, count(*) AS size FROM (SELECT *, (row_number() OVER (PARTITION BY source_sha256, run ORDER BY n) - 1) // 4 AS part FROM (SELECT source_sha256, n, n - row_number() OVER (PARTITION BY source_sha256 ORDER BY n) AS run
FROM (SELECT DISTINCT source_sha256, page.page_number AS n FROM page_cache WHERE page.page_number IS NOT NULL))) GROUP BY source_sha256, run, part""")
def win_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """WN08: consecutive pages in chunks of at most four."""
    return sequences.chunks(table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("n")), ["source_sha256"], "n", 4)


_ANNEX = "SELECT DISTINCT p.source_sha256, p.page.page_number AS start, d.page_count AS last FROM page_cache p JOIN case_documents d ON d.sha256 = p.source_sha256 WHERE p.page.page_number = 1 OR (contains(p.page.text, 'DA ADES') AND p.page.page_number IS NOT NULL)"


def _annexes(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("start"), F.col("page.text").alias("text"))
    docs = table(spark, folder, "case_documents").select(F.col("sha256").alias("source_sha256"), F.col("page_count").alias("last"))
    found = pages.where((F.col("start") == 1) | (F.col("text").contains("DA ADES") & F.col("start").isNotNull())).select("source_sha256", "start").distinct()
    return found.join(docs, "source_sha256")


@query(f"SELECT source_sha256, start, last, coalesce(lead(start) OVER (PARTITION BY source_sha256 ORDER BY start) - 1, last) AS stop FROM ({_ANNEX})")
def win_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """SRC06, WN02, WN23: page ranges from where parts begin."""
    return sequences.ranges_from_starts(_annexes(spark, folder), ["source_sha256"], "start", "last")


@query(f"""SELECT source_sha256, bool_and(ok) AND max(stop) = max(last) AS covers FROM (SELECT *, start = coalesce(lag(stop) OVER (PARTITION BY source_sha256 ORDER BY start), 0) + 1 AND stop >= start AS ok FROM
(SELECT source_sha256, start, last, coalesce(lead(start) OVER (PARTITION BY source_sha256 ORDER BY start) - 1, last) AS stop FROM ({_ANNEX}))) GROUP BY source_sha256""")
def win_cover(spark: SparkSession, folder: str) -> DataFrame:
    """WN03: whether the ranges cover every page once."""
    return sequences.cover_whole(win_ranges(spark, folder), ["source_sha256"], "start", "stop", "last")


@query(f"SELECT DISTINCT r.source_sha256, r.start, p.n FROM ({_ANNEX}) r, unnest(range(r.start, least(r.last, r.start + 1) + 1)) p(n)")
def win_probes(spark: SparkSession, folder: str) -> DataFrame:
    """TK07, JN13, PIPE01: the first two pages of each part."""
    probes = F.sequence(F.col("start"), F.least(F.col("last"), F.col("start") + 1))
    return _annexes(spark, folder).where(F.col("last") >= F.col("start")).select("source_sha256", "start", F.explode(probes).alias("n")).select("source_sha256", "start", F.col("n").cast("long").alias("n")).distinct()


@query("""SELECT DISTINCT source_sha256, m.n FROM (SELECT p.source_sha256, p.page.page_number AS n, d.page_count AS last FROM page_cache p JOIN case_documents d ON d.sha256 = p.source_sha256 WHERE (p.page.text IS NULL OR p.page.text = '') AND p.page.page_number BETWEEN 1 AND d.page_count) u,
unnest(range(greatest(1, n - 1), least(last, n + 1) + 1)) m(n)""")
def win_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """WN20, PIPE02: pages around unreadable ones."""
    pages = table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("n"), F.col("page.text").alias("text")).where("text IS NULL OR text = ''")
    docs = table(spark, folder, "case_documents").select(F.col("sha256").alias("source_sha256"), F.lit(1).alias("low"), F.col("page_count").alias("high"))
    return sequences.neighbours(pages.join(docs, "source_sha256"), ["source_sha256"], "n", "low", "high").select("source_sha256", F.col("n").cast("long").alias("n"))


@query("""SELECT event_id, user_id, CAST(sum(bad) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM
(SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'purchase' THEN 1 ELSE 0 END AS bad FROM events))""")
def win_streaks(spark: SparkSession, folder: str) -> DataFrame:
    """WN18: events in a row without a purchase."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    return sequences.streaks(events, ["user_id"], ["ts", "event_id"], F.col("event_type") != "purchase").select("event_id", "user_id", "streak")


@query("""SELECT event_id, CASE WHEN before IS NULL THEN 0.0 ELSE greatest(0.0, 3600.0 - (epoch_us(ts) - epoch_us(before)) / 1e6) END AS wait FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)""")
def win_spacing(spark: SparkSession, folder: str) -> DataFrame:
    """WN19, SM03: how long each event would have to wait for an hour since the one before."""
    events = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return sequences.spacing(events, ["user_id"], "ts", ["ts", "event_id"], 3600.0).select("event_id", "wait")


_ROLES = """SELECT source_sha256, configuration_sha256, n, CASE WHEN t IS NULL OR t = '' THEN 'U' WHEN contains(t, 'DA ADES') THEN 'A' WHEN contains(t, 'DOS ENCARGOS') THEN 'E' WHEN contains(t, 'Ouvidoria') THEN 'C' ELSE 'N' END AS role FROM
(SELECT source_sha256, configuration_sha256, page.page_number AS n, max(page.text) AS t FROM page_cache WHERE page.page_number IS NOT NULL GROUP BY source_sha256, configuration_sha256, page.page_number)"""


@query(f"""WITH r AS ({_ROLES}), o AS (SELECT *, (role IN ('C', 'E') AND lag(role) OVER w IN ('A', 'C') AND lag(n) OVER w = n - 1) AS goes_on FROM r WINDOW w AS (PARTITION BY source_sha256, configuration_sha256 ORDER BY n)),
g AS (SELECT *, sum(CASE WHEN coalesce(goes_on, false) THEN 0 ELSE 1 END) OVER (PARTITION BY source_sha256, configuration_sha256 ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM o),
h AS (SELECT *, first_value(role) OVER (PARTITION BY source_sha256, configuration_sha256, run ORDER BY n) AS head FROM g),
q AS (SELECT source_sha256, configuration_sha256, min(n) AS start, max(n) AS stop, count(*) AS size, arg_max(role, n) AS last, arg_min(role, n) AS first FROM h GROUP BY source_sha256, configuration_sha256, run, CASE WHEN head = 'A' THEN -1 ELSE n END)
SELECT source_sha256, configuration_sha256, start, stop, size, CASE WHEN first = 'B' OR (first = 'A' AND last = 'E') THEN 'instrument' WHEN first = 'A' THEN 'incomplete' WHEN first IN ('C', 'E') THEN 'orphan' WHEN first = 'U' THEN 'unclear' ELSE 'fragment' END AS outcome FROM q WHERE first <> 'N'""")
def win_instruments(spark: SparkSession, folder: str) -> DataFrame:
    """WN04: instruments that begin, go on and end over consecutive pages."""
    pages = table(spark, folder, "page_cache").select("source_sha256", "configuration_sha256", F.col("page.page_number").alias("n"), F.col("page.text").alias("t")).where("n IS NOT NULL")
    t = F.col("t")
    one = pages.groupBy("source_sha256", "configuration_sha256", "n").agg(F.max("t").alias("t"))
    role = F.when(t.isNull() | (t == ""), "U").when(t.contains("DA ADES"), "A").when(t.contains("DOS ENCARGOS"), "E").when(t.contains("Ouvidoria"), "C").otherwise("N")
    return sequences.instruments(one.select("source_sha256", "configuration_sha256", "n", role.alias("role")), ["source_sha256", "configuration_sha256"], "n", "role")


# --- geometry and layout


def _words(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "page_cache").where("page.words IS NOT NULL")
    return p.select("page_id", geometry.unit_words(F.col("page.words"), F.col("page.width"), F.col("page.height"), F.col("page.rotation")).alias("words"))


_UNIT = """SELECT page_id, i, greatest(0, x0 / w) AS x0, greatest(0, y0 / h) AS y0, least(1, x1 / w) AS x1, least(1, y1 / h) AS y1, text FROM (SELECT page_id, i, text, w, h,
CASE r WHEN 90 THEN w - b.y1 WHEN 180 THEN w - b.x1 WHEN 270 THEN b.y0 ELSE b.x0 END AS x0, CASE r WHEN 90 THEN b.x0 WHEN 180 THEN h - b.y1 WHEN 270 THEN h - b.x1 ELSE b.y0 END AS y0,
CASE r WHEN 90 THEN w - b.y0 WHEN 180 THEN w - b.x0 WHEN 270 THEN b.y1 ELSE b.x1 END AS x1, CASE r WHEN 90 THEN b.x1 WHEN 180 THEN h - b.y0 WHEN 270 THEN h - b.x0 ELSE b.y1 END AS y1
FROM (SELECT page_id, page.width AS w, page.height AS h, page.rotation AS r, i, page.words[i] AS b, page.words[i].text AS text FROM (SELECT *, unnest(range(1, len(page.words) + 1)) AS i FROM page_cache WHERE page.words IS NOT NULL))) WHERE x1 > x0 AND y1 > y0"""


@query(f"SELECT page_id, count(*) AS n, round(min(x0), 6) AS x0, round(min(y0), 6) AS y0, round(max(x1), 6) AS x1, round(max(y1), 6) AS y1 FROM ({_UNIT}) GROUP BY page_id")
def geo_unit_words(spark: SparkSession, folder: str) -> DataFrame:
    """MA06, AG15: bounding box of each page's words, upright in the unit square."""
    w = _words(spark, folder).select("page_id", F.explode("words").alias("w"))
    return w.groupBy("page_id").agg(F.count("*").alias("n"), *[F.round(f(f"w.{c}"), 6).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])


@query(f"SELECT page_id, string_agg(text, ' ' ORDER BY i) AS heading FROM ({_UNIT}) WHERE y0 < 0.24 GROUP BY page_id")
def geo_heading_text(spark: SparkSession, folder: str) -> DataFrame:
    """AG14: the words that begin in the top quarter, in order."""
    return _words(spark, folder).select("page_id", geometry.text_between(F.col("words"), -1.0, 0.24).alias("heading")).where("heading <> ''")


@query("""SELECT page_id, round(least(1.0, list_sum(list_transform(page.image_rects, lambda r: greatest(r[3] - r[1], 0) * greatest(r[4] - r[2], 0))) / (page.width * page.height)), 6) AS fraction FROM page_cache WHERE len(page.image_rects) > 0""")
def geo_image_fraction(spark: SparkSession, folder: str) -> DataFrame:
    """AG16: the part of each page that images cover, at most 1."""
    p = table(spark, folder, "page_cache").where(F.size("page.image_rects") > 0)
    side = lambda r, a, b: F.greatest(F.get(r, F.lit(b)) - F.get(r, F.lit(a)), F.lit(0.0))
    covered = F.reduce(F.transform("page.image_rects", lambda r: side(r, 0, 2) * side(r, 1, 3)), F.lit(0.0), lambda a, x: a + x)
    return p.select("page_id", F.round(F.least(F.lit(1.0), covered / (F.col("page.width") * F.col("page.height"))), 6).alias("fraction"))


@query("""SELECT page_id, count(*) FILTER (EXISTS (SELECT 1 FROM unnest(rects) r(b) WHERE (w.x0 + w.x1) / 2 BETWEEN b[1] AND b[3] AND (w.y0 + w.y1) / 2 BETWEEN b[2] AND b[4])) AS covered, count(*) AS n
FROM (SELECT page_id, page.image_rects AS rects, unnest(page.words) AS w FROM page_cache WHERE page.words IS NOT NULL) GROUP BY page_id""")
def geo_words_in_images(spark: SparkSession, folder: str) -> DataFrame:
    """JN11, JN12, FLT16: words whose centre an image covers; both sides are arrays of one row, so nothing is joined."""
    p = table(spark, folder, "page_cache").where("page.words IS NOT NULL")

    def within(w: Column) -> Column:
        return F.exists(F.coalesce("page.image_rects", F.array().cast("array<array<double>>")), lambda r: geometry.centre_in(w, geometry.box(r[0], r[1], r[2], r[3])))

    return p.where(F.size("page.words") > 0).select("page_id", F.size(F.filter("page.words", within)).cast("long").alias("covered"), F.size("page.words").cast("long").alias("n"))


@query()
def lay_lines(spark: SparkSession, folder: str) -> DataFrame:
    """WN09, AG14, AG15: words clustered into lines; held against a serial statement in the tests."""
    return layout.lines(layout.word_lines(_words(spark, folder), "page_id", "words"), "page_id")


@query()
def lay_cells(spark: SparkSession, folder: str) -> DataFrame:
    """WN10: lines parted into cells."""
    return layout.cells(layout.word_lines(_words(spark, folder), "page_id", "words"), "page_id")


@query()
def lay_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """WN11: empty bands between lines, of 0.003 as the lines of the test tables stand close."""
    return layout.gaps(lay_lines(spark, folder), "page_id", 0.003)


@query()
def lay_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """WN12, WN13, PIPE08: the lines between the header of a page and its next sentence end."""
    n = text.normalized(F.col("text"))
    lines = layout.running_flag(lay_lines(spark, folder).withColumn("n", n), ["page_id"], "line", F.col("n").rlike("^autos"), F.col("n").endswith("."))
    heading = F.col("n").rlike("^autos|^processo|^tribunal|banco") & (F.col("line") < 3)
    return layout.section_blocks(lines, "page_id", heading, heading | F.col("n").endswith("."))


@query(f"SELECT page_id, round(sum((p.x1 - p.x0) * (p.y1 - p.y0)), 6) AS area FROM (SELECT page_id, unnest([{{'x0': 0.0, 'y0': 0.0, 'x1': x0, 'y1': 1.0}}, {{'x0': x1, 'y0': 0.0, 'x1': 1.0, 'y1': 1.0}}, {{'x0': x0, 'y0': 0.0, 'x1': x1, 'y1': y0}}, {{'x0': x0, 'y0': y1, 'x1': x1, 'y1': 1.0}}]) AS p FROM (SELECT page_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM ({_UNIT}) GROUP BY page_id)) WHERE p.x0 < p.x1 AND p.y0 < p.y1 GROUP BY page_id")
def geo_subtracted(spark: SparkSession, folder: str) -> DataFrame:
    """MA08: the area that is left of the page without the box of its words."""
    b = _words(spark, folder).select("page_id", F.explode("words").alias("w")).groupBy("page_id").agg(F.min("w.x0").alias("x0"), F.min("w.y0").alias("y0"), F.max("w.x1").alias("x1"), F.max("w.y1").alias("y1"))
    page = geometry.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    left = geometry.subtract_all(F.array(page), F.array(F.struct("x0", "y0", "x1", "y1")))
    return b.select("page_id", F.explode(left).alias("p")).groupBy("page_id").agg(F.round(F.sum(geometry.area(F.col("p"))), 6).alias("area"))


# --- copies and evaluation


@query("SELECT sha256(page.text) AS fingerprint, min(page_id) AS first_page, count(*) AS copies, count(DISTINCT source_sha256) AS sources FROM page_cache WHERE page.text <> '' GROUP BY 1")
def dup_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """AG17, AG18: pages of equal text with their first page and number of copies."""
    p = table(spark, folder, "page_cache").where("page.text <> ''").select("page_id", "source_sha256", F.sha2("page.text", 256).alias("fingerprint"))
    return p.groupBy("fingerprint").agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"), F.countDistinct("source_sha256").alias("sources"))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS class_id FROM documents WHERE text IS NOT NULL")
def dup_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts: the class of each document; classes are aggregated before they are
    joined back, so copies are never paired."""
    docs = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("h"))
    return docs.join(docs.groupBy("h").agg(F.min("doc_id").alias("class_id")), "h").select("doc_id", "class_id")


@query()
def dup_near_classes(spark: SparkSession, folder: str) -> DataFrame:
    """JN17: the class of each document by equal texts or a Jaccard index of words of 0.55; held
    against brute force in the tests."""
    return copies.near_classes(table(spark, folder, "documents").select("doc_id", "text"))


def _occurrences(spark: SparkSession, folder: str, method: str | None) -> DataFrame:
    pages = table(spark, folder, "page_cache").select("source_sha256", F.col("page.page_number").alias("n"), F.col("page.text_method").alias("m")).where("n IS NOT NULL")
    runs = sequences.islands(pages if method is None else pages.where(F.col("m") == method), ["source_sha256"], "n")
    return runs.select("source_sha256", F.col("start").cast("string").alias("item"), F.sequence("start", "stop").alias("pages"))


# --- pages of HTML, export


@query("SELECT case_id, subject FROM cases WHERE subject IS NOT NULL")
def htm_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """HTM01-HTM04, STR10, SRC12: subjects read back from case pages made of them."""
    cases = table(spark, folder, "cases").where("subject IS NOT NULL").select("case_id", "subject")
    body = F.replace(F.replace(F.col("subject"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    made = cases.select("case_id", F.concat(F.lit("<html><head><title>Processo</title></head><body><table><tr><td>Assunto:</td><td>"), body, F.lit("</td></tr></table></body></html>")).alias("page"))
    return case_pages.labelled_cells(made, "case_id", "page", ["assunto"]).select("case_id", F.col("label_0").alias("subject"))


@query("""SELECT case_id, CASE WHEN h = 3 THEN NULL ELSE process_number END AS number, CASE WHEN h = 3 THEN NULL ELSE projudi_internal_id END AS internal_id, CASE WHEN h = 0 THEN false WHEN h = 1 THEN true END AS is_secret, CASE WHEN h = 0 THEN distribution_at END AS distribution, CASE WHEN h = 0 THEN subject END AS subject, CASE WHEN h = 3 THEN 'identity' END AS error
FROM (SELECT *, CAST(substr(process_number_digits, 7, 1) AS INT) % 4 AS h FROM cases) WHERE projudi_internal_id IS NOT NULL AND subject IS NOT NULL AND distribution_at IS NOT NULL AND process_number_digits IS NOT NULL""")
def htm_cases(spark: SparkSession, folder: str) -> DataFrame:
    """HTM01, HTM02, HTM05: identity, secrecy and cells read back from pages made of the cases; a quarter each is public, secret, unclear and of another case."""
    c = table(spark, folder, "cases").where("projudi_internal_id IS NOT NULL AND subject IS NOT NULL AND distribution_at IS NOT NULL AND process_number_digits IS NOT NULL")
    h = F.substring("process_number_digits", 7, 1).cast("int") % 4
    cell = lambda label, x: F.concat(F.lit(f"<tr><td>{label}:</td><td>"), F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</td></tr>"))
    said = F.when(h == 0, "Não").when(h == 1, "Sim").otherwise("Consulte")
    link = F.concat(F.lit("<a href='/other'>x</a><a href='/projudi/listagens/DadosProcesso?numeroProcesso="), "projudi_internal_id", F.lit("'>"), "process_number", F.lit("</a>"))
    made = c.select("case_id", F.concat(F.lit("<html><body>"), link, F.lit("<table>"), cell("Segredo de Justiça", said), cell("Data de Distribuição", F.col("distribution_at")), cell("Assunto", F.col("subject")), F.lit("</table></body></html>")).alias("page"),
                    F.when(h == 3, F.lit("0000000-00.0000.0.00.0000")).otherwise(F.col("process_number")).alias("expected"))
    labels = case_pages.Labels("segredo de justica", "data de distribuicao", "assunto", ("/projudi/listagens/DadosProcesso", "numeroProcesso"))
    return case_pages.case_rows(made, "case_id", "page", labels, number="expected")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def str_windowed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Windowed counts, the table form of the stream query (an extension)."""
    from resma.streaming.batches import windowed_counts

    return windowed_counts(table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), "ts", "event_type", "1 hour", "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# the queries of documents register themselves in QUERIES and SQL
from resma import queries_documents  # noqa: E402, F401
