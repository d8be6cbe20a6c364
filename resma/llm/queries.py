"""Queries of the text problems: noise (1), personal data (5), packing (7), mixing (8), areas (9)."""

from __future__ import annotations

import os
import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resma.llm import areas, mixing, packing, pii, scans, tokens
from resma.plans.spread import spread
from resma.sources.tables import table


def _scans(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return spread(table(spark, folder, "page_cache").select("page_id", "source_sha256", *more, F.col("page.page_number").alias("page_number"), F.col("page.text").alias("text")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every line that is furniture, ends within a word, or holds misread words."""
    return scans.read_pages(_scans(spark, folder), found=True)


def p1_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """The page texts as continuous paragraphs."""
    return scans.read_pages(_scans(spark, folder, "configuration_sha256"), found=False)


#: Where a deployment states the key of its pseudonyms; values stay linked as long as it is kept.
KEY_SETTING = "spark.resma.pseudonymKey"
_drawn: dict[str, str] = {}


def pseudonym_key(spark: SparkSession) -> str:
    """The configured key, or, where none is, one drawn for this application: nobody can undo its
    pseudonyms, and they link values within its results only."""
    named = spark.conf.get(KEY_SETTING, None) or os.environ.get("RESMA_PSEUDONYM_KEY")
    return named or _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def _page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "page_cache").select("page_id", F.col("page.text").alias("text")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every mention of a natural person's mail, phone, number, address or name."""
    pages = _page_texts(spark, folder)
    return pii.found_values(pages, pii.mine_lexicon(pages)).select("page_id", "kind", "start_pos")


def p5_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """The page texts with placeholders for personal values."""
    pages = _page_texts(spark, folder)
    return pii.redact_pages(pages, pii.mine_lexicon(pages), pseudonym_key(spark))


def p7_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Container and place of every document's text, with the container's fill."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return packing.pack(tokens.with_tokens(docs))


def p7_fills(spark: SparkSession, folder: str) -> DataFrame:
    """The fill of each container."""
    return packing.container_fills(p7_packed(spark, folder))


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = spread(table(spark, folder, "documents").select("doc_id", "source", "text", F.xxhash64("text").alias("h1"), F.md5("text").alias("h2")))
    return mixing.mix(tokens.with_tokens(docs), table(spark, folder, "source_targets"), text_hash=("h1", "h2"))


def p8_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """The documents used and how often."""
    return _mixed(spark, folder)[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share each source really reaches."""
    return _mixed(spark, folder)[1]


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(table(spark, folder, "documents").select("doc_id", "text", "n_chars"))
    labels = table(spark, folder, "subject_labels").select("doc_id", "area")
    rules = areas.mine(areas.labelled_sample(docs, labels))
    return areas.assign(docs, rules, keep=("n_chars",))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """The areas of every document."""
    return _assigned(spark, folder).select("doc_id", "area")


def p9_composition(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus by area."""
    return areas.composition(_assigned(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p1_repaired": p1_repaired,
    "p5_found": p5_found, "p5_redacted": p5_redacted,
    "p7_packed": p7_packed, "p7_fills": p7_fills, "p8_mixed": p8_mixed, "p8_shares": p8_shares,
    "p9_found": p9_found, "p9_composition": p9_composition,
}
