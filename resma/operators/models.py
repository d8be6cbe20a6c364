"""Pluggable models and readers: recognisers, classifiers and page sources as functions of a
batch, with their answers kept by the hash of what was asked and checked before they count."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Asks about a batch of requests (texts); one answer each, None where the model gives none that is whole.
Classifier = Callable[[list[str]], list[str | None]]


def request_key(*parts: Column) -> Column:
    """The hash under which an answer is kept: all that the answer depends on, by name and place."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])), 256)


def asked(requests: DataFrame, key: str, request: str, classifier: Callable[[], Classifier], cache: DataFrame | None = None, most: int = 4) -> DataFrame:
    """(key, answer, cached): equal requests are asked once, ``most`` at a time; what ``cache`` (key,
    answer) holds is not asked. ``classifier`` makes the model where a task runs. Answers are not
    kept where the model gave none (cut off, saturated): no absence is made of them."""
    one = requests.groupBy(key).agg(F.min(request).alias(request))
    kept = cache.select(key, F.col("answer")).where("answer IS NOT NULL") if cache is not None else None
    open_ = one.join(kept, key, "left_anti") if kept is not None else one
    kind = requests.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = classifier()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            answers: list[str | None] = []
            for i in range(0, len(texts), most):
                got = model(texts[i : i + most])
                if len(got) != len(texts[i : i + most]):
                    raise ValueError("the model gave another number of answers than was asked for")
                answers += got
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(answers, pa.string())], names=[key, "answer"])

    new = open_.select(key, request).mapInArrow(run, f"`{key}` {kind}, answer string").withColumn("cached", F.lit(False))
    if kept is None:
        return new
    return new.unionByName(one.select(key).join(kept, key).withColumn("cached", F.lit(True)))


def checked_answer(answer: Column, schema: str, checks: Callable[[Column], Column]) -> Column:
    """An answer read by ``schema`` if it is strict JSON that has all its members in their types and
    ``checks`` hold of it; else null."""
    strict = F.try_parse_json(answer)
    read = F.when(strict.isNotNull() & F.schema_of_variant(strict).startswith("OBJECT"), F.try_variant_get(strict, "$", schema))
    return F.when(F.coalesce(checks(read), F.lit(False)), read)


def read_units(files: DataFrame, path: str, content: str, reader: Callable[[], Callable[[bytes], list[tuple[int, str]]]]) -> DataFrame:
    """(path, number, text, error) of the units (pages) that ``reader`` finds in binary files, as of
    Spark's ``binaryFile`` source; a reader that fails gives one row with the error. The reader
    (PDF, recognition) is the caller's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            out: list[tuple] = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    out += [(name, n, t, None) for n, t in read(data or b"")]
                except Exception as fault:  # noqa: BLE001 - a reader's fault belongs to its file
                    out.append((name, None, None, f"{type(fault).__name__}: {fault}"[:250]))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string()))], names=["path", "number", "text", "error"])

    return files.select(F.col(path).cast("string"), content).mapInArrow(run, "path string, number int, text string, error string")


def recognised_words(lines: DataFrame, key: str, tsv: str) -> DataFrame:
    """(key, nth, x0, y0, x1, y1, text, confidence) of the word rows (level 5) of a recogniser's
    tab-separated result: twelve columns, not blank, of some width and height."""
    cells = lines.select(key, F.posexplode(F.split(tsv, r"\r?\n")).alias("nth", "row")).withColumn("c", F.split("row", "\t"))
    at = lambda i: F.get("c", F.lit(i)).try_cast("double")
    words = cells.where((F.size("c") >= 12) & (F.get("c", F.lit(0)) == "5") & (F.trim(F.get("c", F.lit(11))) != "") & (at(8) > 0) & (at(9) > 0))
    return words.select(key, "nth", at(6).alias("x0"), at(7).alias("y0"), (at(6) + at(8)).alias("x1"), (at(7) + at(9)).alias("y1"), F.trim(F.get("c", F.lit(11))).alias("text"), at(10).alias("confidence"))


def file_faults(content: Column, sha256: Column, pages: Column | None = None, tail: int = 65_536) -> Column:
    """The first fault of a stored document: size, magic, end_marker (in the last bytes), hash, pages."""
    size = F.octet_length(content)
    end = F.decode(F.substring(content, -tail, tail), "ISO-8859-1")
    rules = [
        ("size", size >= 8), ("magic", F.substring(content, 1, 5) == F.encode(F.lit("%PDF-"), "UTF-8")),
        ("end_marker", end.contains("%%EOF")), ("hash", F.sha2(content, 256) == sha256), *([("pages", pages >= 1)] if pages is not None else []),
    ]
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules])
