"""Records held against ordered rules, files against their sidecars, and constraints between tables.

Rules are data: (code, condition that must hold). The first rule that does not hold names the
fault, so cheap and basic rules come first and later ones may rely on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resma.functions.numbers import process_digits
from resma.functions.text import url_fault
from resma.operators.rejects import strict_objects

Rules = list[tuple[str, Column]]

# The fields every record must have.
REQUIRED = [
    "url_download", "process_number", "process_number_digits", "process_year", "source_url", "codigo_hash", "projudi_internal_id", "distribution_at",
    "subject", "is_secret", "classe", "datajud_subjects", "orgao_julgador", "data_ajuizamento", "arquivos", "avisos",
]


def first_fault(rules: Rules) -> Column:
    """The code of the first rule that does not hold (null counts as not holding), else null."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules])


def member(record: Column, path: str, kind: str) -> Column:
    """A member of a variant as ``kind``; null where it is absent or of another JSON type."""
    return F.try_variant_get(record, path, kind)


def json_kind(record: Column, path: str) -> Column:
    """The type of a member of a variant as Spark names it (BIGINT, STRING, ARRAY<...>); VOID is
    JSON null, null an absent member."""
    return F.schema_of_variant(F.try_variant_get(record, path, "variant"))


def record_rules(record: Column, host: str, download_path: str, case_path: str, court: str | None = None) -> Rules:
    """The rules of a case record, in order. ``record``: a variant; ``host`` and the paths tell
    the only URLs allowed, ``court`` the digits of branch and court."""
    text = lambda name: F.when(json_kind(record, f"$.{name}") == "STRING", member(record, f"$.{name}", "string"))
    kind = lambda name: json_kind(record, f"$.{name}")
    number, internal = text("process_number"), text("projudi_internal_id")
    digits = process_digits(number)
    form = number.rlike(r"^\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}\z")
    offset = r"(Z|[+-]\d{2}:?\d{2})\z"
    moment, filed = text("distribution_at"), text("data_ajuizamento")
    nullable = lambda name, kinds: kind(name).isin("VOID", *kinds)
    count = lambda name: (json_kind(record, f"$.arquivos.{name}").isin("BIGINT", "TINYINT", "SMALLINT", "INT")) & (member(record, f"$.arquivos.{name}", "bigint") >= 0)
    texts = lambda name: kind(name).isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(F.coalesce(member(record, f"$.{name}", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.is_variant_null(x))
    rules = [
        ("object", F.schema_of_variant(record).startswith("OBJECT")),
        ("missing_fields", F.size(missing_fields(record)) == 0),
        ("number_form", form),
        ("number_check", digits.isNotNull()),
        ("digits_differ", text("process_number_digits") == digits),
        ("year_differs", kind("process_year").isin("BIGINT", "TINYINT", "SMALLINT", "INT") & (member(record, "$.process_year", "bigint") == F.substring(digits, 10, 4).cast("bigint"))),
        ("internal_id", internal.rlike(r"^[0-9]{1,20}\z")),
        ("url_download", url_fault(text("url_download"), host, path=download_path, parameter="numeroProcesso", value=number).isNull() & text("url_download").isNotNull()),
        ("source_url", url_fault(text("source_url"), host, path=case_path, parameter="numeroProcesso", value=internal).isNull() & text("source_url").isNotNull()),
        ("court", F.lit(True) if court is None else F.substring(digits, 14, 3) == court),
        ("codigo_hash", kind("codigo_hash") == "VOID"),
        ("is_secret", nullable("is_secret", ["BOOLEAN"])),
        ("dates_are_text", moment.isNotNull() & filed.isNotNull()),
        ("distribution_offset", F.try_to_timestamp(moment).isNotNull() & moment.rlike(offset)),
        ("filing_date", filed.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_timestamp(filed, F.lit("yyyy-MM-dd")).isNotNull()),
        ("nullable_texts", nullable("subject", ["STRING"]) & nullable("classe", ["STRING"]) & nullable("orgao_julgador", ["STRING"])),
        ("text_lists", texts("datajud_subjects") & texts("avisos")),
        ("counts", count("links_detectados") & count("restricoes_detectadas")),
    ]
    return rules


def missing_fields(record: Column, required: list[str] = REQUIRED) -> Column:
    """The required names that a variant object lacks, in order (a null member is present)."""
    present = F.array_compact(F.array(*[F.when(F.try_variant_get(record, f"$.{n}", "variant").isNotNull(), F.lit(n)) for n in required]))
    return F.sort_array(F.array_except(F.array(*map(F.lit, required)), present))


def checked_records(lines: DataFrame, rules_of, raw: str = "raw_json") -> DataFrame:
    """``lines`` with ``fault``, the first rule of ``rules_of(variant)`` that does not hold.
    Lines that are not strict JSON, null and empty ones have the fault ``object``."""
    parsed = strict_objects(lines, raw, "_record")
    return parsed.withColumn("fault", first_fault(rules_of(F.col("_record")))).drop("_record")


def first_seen(rows: DataFrame, file: str, line: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``duplicate_of``: the least line of the file that has one of the ``keys`` of
    this row before it; null for rows that are the first with each of their keys. Null keys are
    like no other. One partial aggregate a key: no key's rows are brought together in a window."""
    out = rows
    for i, k in enumerate(keys):
        firsts = rows.where(F.col(k).isNotNull()).groupBy(file, k).agg(F.min(line).alias(f"_first{i}"))
        out = out.join(firsts, [file, k], "left")
    earlier = [F.when(F.col(f"_first{i}") < F.col(line), F.col(f"_first{i}")) for i in range(len(keys))]
    least = F.least(*earlier) if len(earlier) > 1 else earlier[0]
    return out.withColumn("duplicate_of", least).select(*rows.columns, "duplicate_of")


def first_error(faults: DataFrame, file: str, line: str, fault: str) -> DataFrame:
    """(file, line, fault) of the first faulty line of each file."""
    bad = faults.where(F.col(fault).isNotNull())
    return bad.groupBy(file).agg(F.min(F.struct(line, fault)).alias("_first")).select(file, f"_first.{line}", f"_first.{fault}")


def field_coverage(records: DataFrame, file: str, raw: str = "raw_json") -> DataFrame:
    """(file, field, present): for each top-level field the number of records of the file in
    which it is not null. Texts that are no JSON object count nowhere."""
    members = F.try_variant_get("_record", "$", "map<string,variant>")
    return strict_objects(records.select(file, raw), raw, "_record").select(file, F.explode(members).alias("field", "value")).where(~F.is_variant_null("value")).groupBy(file, "field").agg(F.count("*").alias("present"))


def coverage_differences(files: DataFrame, coverage: DataFrame, file: str = "dataset_id", metadata: str = "metadata_json", member_name: str = "cobertura_campos") -> DataFrame:
    """(file, field, stated, present) where the coverage that a sidecar states is not what the
    records have. Sidecars without that map state nothing; a field stated as 0 may be absent."""
    stated = F.try_variant_get(F.try_parse_json(metadata), f"$.{member_name}", "map<string,bigint>")
    said = files.select(file, F.explode(stated).alias("field", "stated"))
    both = said.join(coverage, [file, "field"], "left").withColumn("present", F.coalesce("present", F.lit(0)))
    return both.where(~F.col("stated").eqNullSafe(F.col("present")))


def overlapping_positions(items: DataFrame, entity: str, pages: str) -> DataFrame:
    """(entity, page, items): pages that more than one item of an entity claims."""
    each = items.select(entity, F.explode(F.array_distinct(pages)).alias("page"))
    return each.groupBy(entity, "page").agg(F.count("*").alias("items")).where("items > 1")


def is_consecutive(pages: Column) -> Column:
    """Whether an array of positions is a run without gap or repeat; an empty or null one is none."""
    return F.coalesce((F.size(pages) > 0) & (F.array_max(pages) - F.array_min(pages) + 1 == F.size(pages)) & (F.size(F.array_distinct(pages)) == F.size(pages)), F.lit(False))


def not_within(rows: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``rows`` that ``allowed`` lacks, each once: empty if the one is part of the other."""
    return rows.select(*keys).distinct().join(allowed.select(*keys).distinct(), keys, "left_anti")


def shared(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(key, value): the values of any of ``keys`` that both tables hold; empty if they are disjoint on each key."""
    out = None
    for k in keys:
        both = a.select(F.col(k).cast("string").alias("value")).where("value IS NOT NULL").intersect(b.select(F.col(k).cast("string").alias("value")))
        named = both.select(F.lit(k).alias("key"), "value")
        out = named if out is None else out.unionByName(named)
    return out


def zipped(a: Column, b: Column) -> Column:
    """Pairs of two arrays by position, or null where they differ in length: an answer that
    misses or adds an item fits no question."""
    return F.when(F.size(a) == F.size(b), F.arrays_zip(a, b))


def latest_n(df: DataFrame, order: list[Column], n: int, among: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """The first ``n`` rows in the given order, or all rows whose ``key`` is in ``among``."""
    return df.join(among.select(key).distinct(), key, "left_semi") if among is not None else df.orderBy(*order).limit(n)


def partition_first(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first ``n`` rows by ``order`` (all if null), numbered from 1 in ``position``."""
    if n is None:
        return df.withColumn("position", F.row_number().over(Window.partitionBy(order[0]).orderBy(*order[1:])))
    return df.orderBy(*order).limit(n).withColumn("position", F.row_number().over(Window.orderBy(*order)))  # at most n rows
