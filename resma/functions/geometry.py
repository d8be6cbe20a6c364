"""Rectangles and positioned words as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def unit_words(words: Column, width: Column, height: Column, rotation: Column) -> Column:
    """``words`` (x0, y0, x1, y1, text) turned upright and scaled to the unit square; empty
    rectangles are left out, others clipped."""

    def upright(w: Column) -> Column:
        turned = (
            F.when(rotation == 90, box(width - w["y1"], w["x0"], width - w["y0"], w["x1"]))
            .when(rotation == 180, box(width - w["x1"], height - w["y1"], width - w["x0"], height - w["y0"]))
            .when(rotation == 270, box(w["y0"], height - w["x1"], w["y1"], height - w["x0"]))
            .otherwise(box(w["x0"], w["y0"], w["x1"], w["y1"]))
        )
        return F.struct(turned.alias("b"), w["text"].alias("text"))

    zero, one = F.lit(0.0), F.lit(1.0)
    kept = F.filter(F.transform(words, upright), lambda w: (w["b"]["x1"] > w["b"]["x0"]) & (w["b"]["y1"] > w["b"]["y0"]))
    return F.transform(kept, lambda w: F.struct(
        F.greatest(zero, w["b"]["x0"] / width).alias("x0"), F.greatest(zero, w["b"]["y0"] / height).alias("y0"),
        F.least(one, w["b"]["x1"] / width).alias("x1"), F.least(one, w["b"]["y1"] / height).alias("y1"), w["text"].alias("text"),
    ))


def centre_in(word: Column, rect: Column) -> Column:
    x, y = (word["x0"] + word["x1"]) / 2, (word["y0"] + word["y1"]) / 2
    return x.between(rect["x0"], rect["x1"]) & y.between(rect["y0"], rect["y1"])


def area(rect: Column) -> Column:
    return F.greatest(rect["x1"] - rect["x0"], F.lit(0.0)) * F.greatest(rect["y1"] - rect["y0"], F.lit(0.0))


def padded(rect: Column, pad: float) -> Column:
    return box(F.greatest(F.lit(0.0), rect["x0"] - pad), F.greatest(F.lit(0.0), rect["y0"] - pad), F.least(F.lit(1.0), rect["x1"] + pad), F.least(F.lit(1.0), rect["y1"] + pad))


def valid_unit(rect: Column) -> Column:
    """0 <= x0 < x1 <= 1 and the same of y; NaN and null are not valid."""
    ok = (rect["x0"] >= 0) & (rect["x0"] < rect["x1"]) & (rect["x1"] <= 1) & (rect["y0"] >= 0) & (rect["y0"] < rect["y1"]) & (rect["y1"] <= 1)
    return F.coalesce(ok, F.lit(False))


def subtract(rect: Column, cut: Column) -> Column:
    """What of ``rect`` lies outside of ``cut``: the bands above and below it over the whole width,
    then what stands beside it; at most four rectangles."""
    low, high = F.greatest(rect["y0"], cut["y0"]), F.least(rect["y1"], cut["y1"])
    left, right = F.greatest(rect["x0"], cut["x0"]), F.least(rect["x1"], cut["x1"])
    apart = (low >= high) | (left >= right)
    bands = [(rect["x0"], rect["y0"], rect["x1"], low), (rect["x0"], high, rect["x1"], rect["y1"]), (rect["x0"], low, left, high), (right, low, rect["x1"], high)]
    full = F.filter(F.array(*[box(*b) for b in bands]), lambda p: (p["x1"] > p["x0"]) & (p["y1"] > p["y0"]))
    return F.when(apart, F.array(box(rect["x0"], rect["y0"], rect["x1"], rect["y1"]))).otherwise(full)


def subtract_all(rects: Column, cuts: Column) -> Column:
    """``rects`` without any of ``cuts``."""
    return F.reduce(cuts, rects, lambda left, cut: F.flatten(F.transform(left, lambda r: subtract(r, cut))))


def text_between(words: Column, low: float, high: float) -> Column:
    """The words that begin between two heights (low inclusive, high exclusive), in order."""
    return F.array_join(F.transform(F.filter(words, lambda w: (w["y0"] >= low) & (w["y0"] < high)), lambda w: w["text"]), " ")


def pixel_box(rect: Column, width: int, height: int) -> Column:
    """The smallest box of whole pixels around a valid unit rectangle, else null."""
    whole = F.struct(
        F.floor(rect["x0"] * width).cast("int").alias("x0"), F.floor(rect["y0"] * height).cast("int").alias("y0"),
        F.ceil(rect["x1"] * width).cast("int").alias("x1"), F.ceil(rect["y1"] * height).cast("int").alias("y1"),
    )
    return F.when(valid_unit(rect), whole)


def admitted(rects: Column, least: float = 0.03, most: float = 0.97, near: float = 0.006, limit: int = 64) -> Column:
    """Of unit rectangles, in order: the valid ones of an area from ``least`` to ``most`` (the whole
    page too) that differ from each one kept before by ``near`` on some side; at most ``limit``
    (a feature: what is shown for a decision)."""
    whole = lambda r: (r["x0"] == 0) & (r["y0"] == 0) & (r["x1"] == 1) & (r["y1"] == 1)
    fit = F.filter(rects, lambda r: valid_unit(r) & (area(r) >= least) & ((area(r) <= most) | whole(r)))
    apart = lambda a, b: F.greatest(*[F.abs(a[c] - b[c]) for c in ("x0", "y0", "x1", "y1")]) >= near
    kept = F.reduce(fit, F.slice(fit, 1, 0), lambda done, r: F.when(F.forall(done, lambda k: apart(r, k)), F.concat(done, F.array(r))).otherwise(done))
    return F.slice(kept, 1, limit)


def graphics(rects: Column) -> Column:
    """Unit rectangles of the size of a picture or code, not of a scanned strip."""
    return F.filter(rects, lambda r: valid_unit(r) & (area(r) > 0.0001) & (area(r) < 0.15) & (r["x1"] - r["x0"] < 0.6) & (r["y1"] - r["y0"] < 0.45))


def cropped(words: Column, rect: Column) -> Column:
    """Words whose centre lies in ``rect``, in the unit square of that rectangle; clipped at its edges."""
    w, h = rect["x1"] - rect["x0"], rect["y1"] - rect["y0"]
    zero, one = F.lit(0.0), F.lit(1.0)
    unit = lambda v, low, size: F.least(one, F.greatest(zero, (v - low) / size))
    return F.transform(F.filter(words, lambda x: centre_in(x, rect)), lambda x: F.struct(
        unit(x["x0"], rect["x0"], w).alias("x0"), unit(x["y0"], rect["y0"], h).alias("y0"), unit(x["x1"], rect["x0"], w).alias("x1"), unit(x["y1"], rect["y0"], h).alias("y1"), x["text"].alias("text"),
    ))
