"""Lines, cells and gaps of positioned words.

Clustering words into lines depends on the order in which they are met, so each page is
clustered on its own where it is read (no shuffle: the words are one row's array); cells and
gaps are then windows over the lines and words of a page.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A word joins a line whose centre is within this part of the larger height.
SAME_LINE = 0.40
#: Only so many lines before are asked, the newest first.
LOOK_BACK = 5
CELL_GAP = 0.028
LINE_GAP = 0.009


def line_numbers(words: list[dict]) -> list[int]:
    """The line of each word. Words are met by centre, then left edge; a line keeps the centre
    and height of its first word; lines are numbered from the top."""
    met = sorted(range(len(words)), key=lambda i: ((words[i]["y0"] + words[i]["y1"]) / 2, words[i]["x0"]))
    centres: list[float] = []
    heights: list[float] = []
    of = [0] * len(words)
    for i in met:
        centre, height = (words[i]["y0"] + words[i]["y1"]) / 2, words[i]["y1"] - words[i]["y0"]
        for k in range(len(centres) - 1, max(-1, len(centres) - 1 - LOOK_BACK), -1):
            if abs(centres[k] - centre) <= SAME_LINE * max(height, heights[k]):
                of[i] = k
                break
        else:
            of[i] = len(centres)
            centres.append(centre)
            heights.append(height)
    place = {k: n for n, k in enumerate(sorted(range(len(centres)), key=lambda k: centres[k]))}
    return [place[k] for k in of]


def word_lines(pages: DataFrame, key: str, words: str) -> DataFrame:
    """(key, line, nth, x0, y0, x1, y1, text): one row per word with its line (from 0) and its
    place in it from the left. Null word lists give no rows."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "line", "nth", "x0", "y0", "x1", "y1", "text"]
        types = [None, pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.string()]
        for batch in batches:
            at, rows = [], []
            for i, ws in enumerate(batch.column(1).to_pylist()):
                if not ws:
                    continue
                ws = [w for w in ws if w is not None]
                lines = line_numbers(ws)
                count: dict[int, int] = {}
                for k in sorted(range(len(ws)), key=lambda k: (lines[k], ws[k]["x0"])):
                    n = count[lines[k]] = count.get(lines[k], -1) + 1
                    at.append(i)
                    rows.append((lines[k], n, ws[k]["x0"], ws[k]["y0"], ws[k]["x1"], ws[k]["y1"], ws[k]["text"]))
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types[1:])]], names=names)

    return pages.select(key, words).mapInArrow(run, f"`{key}` {kind}, line int, nth int, x0 double, y0 double, x1 double, y1 double, text string")


def lines(placed: DataFrame, key: str) -> DataFrame:
    """(key, line, text, x0, y0, x1, y1, words) of placed words."""
    grouped = placed.groupBy(key, "line").agg(F.sort_array(F.collect_list(F.struct("nth", "text"))).alias("w"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return grouped.select(key, "line", F.array_join(F.transform("w", lambda w: w["text"]), " ").alias("text"), "x0", "y0", "x1", "y1", F.size("w").alias("words"))


def cells(placed: DataFrame, key: str, gap: float = CELL_GAP) -> DataFrame:
    """(key, line, cell, text, x0, y0, x1, y1): lines parted where words stand apart by more than ``gap``."""
    w = Window.partitionBy(key, "line").orderBy("nth")
    apart = F.coalesce(F.col("x0") - F.lag("x1").over(w) > gap, F.lit(False)).cast("int")
    numbered = placed.withColumn("_apart", apart).withColumn("cell", F.sum("_apart").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    grouped = numbered.groupBy(key, "line", "cell").agg(F.sort_array(F.collect_list(F.struct("nth", "text"))).alias("w"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return grouped.select(key, "line", F.col("cell").cast("int").alias("cell"), F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), "x0", "y0", "x1", "y1")


def gaps(found_lines: DataFrame, key: str, least: float = LINE_GAP) -> DataFrame:
    """(key, line, top, bottom): the empty bands of more than ``least`` above lines."""
    above = F.lag("y1").over(Window.partitionBy(key).orderBy("line"))
    return found_lines.withColumn("top", above).where(F.col("y0") - F.col("top") > least).select(key, "line", "top", F.col("y0").alias("bottom"))


def section_blocks(found_lines: DataFrame, key: str, heading, stop) -> DataFrame:
    """(key, line, last): for each line for which ``heading`` holds, the last line before the
    next one for which ``stop`` holds (or of the page). ``heading`` and ``stop`` are columns."""
    after = Window.partitionBy(key).orderBy("line").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(key)
    marked = found_lines.withColumn("_stop", F.min(F.when(stop, F.col("line"))).over(after)).withColumn("_last", F.max("line").over(whole))
    ends = F.coalesce(F.col("_stop") - 1, F.col("_last"))
    return marked.where(F.coalesce(heading, F.lit(False))).select(key, "line", ends.alias("last")).where(F.col("last") > F.col("line"))


def running_flag(df: DataFrame, entity: list[str], order: str, on, off, out: str = "inside") -> DataFrame:
    """``df`` with ``out``: whether the last row so far for which ``on`` or ``off`` holds was an ``on``."""
    w = Window.partitionBy(*entity).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.coalesce(F.last(F.when(on, True).when(off, False), ignorenulls=True).over(w), F.lit(False)))
