"""Sizes of texts in tokens of a public byte-level BPE tokenizer.

The vocabulary is read from ``folder`` on each executor. A byte-level BPE never joins across
the beginning of a space-led word, so a text's size is the sum of the sizes of its words; the
sizes of words met before are kept, and only new words reach the tokenizer. Texts with other
white space inside words' edges are encoded whole, so every size is exact.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("RESMA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Fixed value: how the byte-level BPE vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words whose sizes one worker keeps; beyond, it starts anew.
KEPT_WORDS = 1_000_000


class WordSizes(dict):
    """Token counts of words led by a space; NaN marks words that cannot stand alone."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        alone = not word or word[0].isspace() or word[-1].isspace()
        size = self[word] = float("nan") if alone else float(len(self.encode(" " + word)))
        return size


@lru_cache(maxsize=4)
def encoding(folder: str, vocabulary: str):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def counter(folder: str, vocabulary: str):
    """A function from text to its number of tokens."""
    encode = encoding(folder, vocabulary).encode_ordinary
    sizes = WordSizes(encode)
    get = sizes.__getitem__

    def count(text: str) -> int:
        first, space, rest = text.partition(" ")
        if not space or not first or first[-1:].isspace():
            return len(encode(text))
        total = sum(map(get, rest.split(" ")))
        if total != total:  # NaN
            return len(encode(text))
        return int(total) + len(encode(first))

    return count


def with_tokens(docs: DataFrame, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` (the columns ``keep``, by default all but the text) with the size of ``text``.
    A null or empty text has 0 tokens. A column named as ``out`` is replaced."""
    kept = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c != out]
    rows = docs.select(*kept, F.col(text).alias("__text"))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out}` int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(folder, vocabulary)
        for batch in batches:
            sizes = [count(t) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int32())], names=[*kept, out])

    return rows.mapInArrow(run, schema)
