"""Files of JSON lines with their sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(input_path, line_number, raw_json) of files of lines. Lines of one file are numbered in
    order from 1: each file is read whole by one task, as numbers need all lines before. A byte
    order mark at the start of a file is dropped; a last empty line is no line."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("input_path"), F.regexp_replace("value", "^﻿", "").alias("value"))
    lines = F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")
    return files.select("input_path", F.posexplode(lines).alias("n", "raw_json")).select("input_path", (F.col("n") + 1).cast("int").alias("line_number"), "raw_json")


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(metadata_path, metadata_json) of sidecar files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("metadata_path"), F.col("value").alias("metadata_json"))


def reconciled(files: DataFrame, lines: DataFrame, file: str = "dataset_id", metadata: str = "metadata_json", names: tuple[str, ...] = ("total_registros", "total_linhas")) -> DataFrame:
    """(file, stated, lines, agrees): the count each sidecar states against the lines there are;
    a file without lines has 0, a sidecar without a count states null and agrees with nothing."""
    stated = F.coalesce(*[F.get_json_object(metadata, f"$.{n}") for n in names]).try_cast("long")
    counts = lines.groupBy(file).agg(F.count("*").alias("lines"))
    both = files.select(file, stated.alias("stated")).join(counts, file, "left")
    have = F.coalesce("lines", F.lit(0))
    return both.select(file, "stated", have.alias("lines"), F.coalesce(F.col("stated") == have, F.lit(False)).alias("agrees"))
