"""Boxes and image sizes as expressions; ink projections as an Arrow UDF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Fixed values of the split search.
INK, LEAST_SIZE, SPLIT_FROM, SPLIT_TO, SPLIT_STEP = 200, 16, 0.38, 0.62, 0.01
BAND, FLANK_FAR, FLANK_NEAR, LEAST_INK = 0.04, 0.35, 0.08, 0.008
WIDE, SURE, NONE = 1.25, 0.55, 0.30


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def polygon_box(points: Column | str) -> Column:
    """The box of an array of (x, y) arrays."""
    xs, ys = F.transform(col(points), lambda p: p[0]), F.transform(col(points), lambda p: p[1])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def clamp(b: Column, width: Column, height: Column) -> Column:
    """A box within an image, of which a pixel is left at least."""
    low = lambda x, size: F.greatest(F.lit(0.0), F.least(x.cast("double"), size.cast("double") - 1))
    high = lambda x, size: F.greatest(F.lit(1.0), F.least(x.cast("double"), size.cast("double")))
    return box(low(b["x1"], width), low(b["y1"], height), high(b["x2"], width), high(b["y2"], height))


def whole(b: Column) -> Column:
    """A box in whole pixels, of one pixel at least."""
    x1, y1, x2, y2 = (b[k].cast("int") for k in ("x1", "y1", "x2", "y2"))
    return box(x1, y1, F.greatest(x2, x1 + 1), F.greatest(y2, y1 + 1))


def crop_box(b: Column, width: Column, height: Column, pad: int = 2) -> Column:
    w = whole(clamp(b, width, height))
    return box(F.greatest(F.lit(0), w["x1"] - pad), F.greatest(F.lit(0), w["y1"] - pad), F.least(width.cast("int"), w["x2"] + pad), F.least(height.cast("int"), w["y2"] + pad))


def to_pixels(norm: Column, width: Column, height: Column) -> Column:
    """A box of shares of the page in whole pixels."""
    low = lambda v, size: F.greatest(F.lit(0), (v * size).cast("int"))
    high = lambda v, size: F.least(size.cast("int"), F.greatest(F.lit(1), (v * size).cast("int")))
    return box(low(norm["x1"], width), low(norm["y1"], height), high(norm["x2"], width), high(norm["y2"], height))


def panel_boxes(kind: Column | str, margin: Column, split: Column) -> Column:
    """(version_id, box) of each panel of a page with 2 or 4; an error for other classes."""
    m = F.greatest(F.lit(0.0), F.least(F.lit(0.05), margin))
    s = F.greatest(F.lit(0.25), F.least(F.lit(0.75), split))
    panel = lambda v, *b: F.struct(F.lit(v).alias("version_id"), box(*[x if isinstance(x, Column) else F.lit(float(x)) for x in b]).alias("box"))
    end, h = F.lit(1.0) - m, F.lit(0.5)
    two = F.array(panel("v0", m, 0, s - m, 1), panel("v1", s + m, 0, end, 1))
    four = F.array(panel("v0", m, m, h - m, h - m), panel("v1", h + m, m, end, h - m), panel("v2", m, h + m, h - m, end), panel("v3", h + m, h + m, end, end))
    return F.when(col(kind) == "2_lr", two).when(col(kind) == "4_2x2", four).otherwise(F.raise_error(F.concat(F.lit("no panels for class "), col(kind))).cast(two_type()))


def two_type() -> str:
    return "array<struct<version_id:string,box:struct<x1:double,y1:double,x2:double,y2:double>>>"


def remap(b: Column, panel: Column, width: Column, height: Column) -> Column:
    """A box in a panel as one on its page. panel: its box in shares of the page."""
    dx, dy = panel["x1"] * width, panel["y1"] * height
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def pixel_budget(width: Column, height: Column, most: int = 0, least: int = 0) -> Column:
    """(width, height) scaled down to most pixels, then up to least; 0: no limit."""

    def scaled(w: Column, h: Column, limit: int, off: Column) -> tuple[Column, Column]:
        by = F.sqrt(F.lit(float(limit)) / (w * h))
        part = lambda x: F.when(off, F.greatest(F.lit(1), F.floor(x * by).cast("int"))).otherwise(x)
        return part(w), part(h)

    w, h = width.cast("int"), height.cast("int")
    if most > 0:
        w, h = scaled(w, h, most, w * h > most)
    if least > 0:
        w, h = scaled(w, h, least, w * h < least)
    return F.struct(w.alias("width"), h.alias("height"))


def mean_or_none(x: np.ndarray, lo: int, hi: int) -> float | None:
    part = x[max(0, lo) : max(hi, lo + 1)]
    return float(part.mean()) if len(part) else None


def split_score(ink: np.ndarray, at: float) -> float:
    """How far the ink at a place differs from that to its sides, 0 to 1."""
    n = len(ink)
    mid, half = round(at * (n - 1)), max(1, int(n * BAND / 2))
    here = mean_or_none(ink, mid - half, mid + half)
    sides = [mean_or_none(ink, int((at + a) * n), int((at + b) * n)) for a, b in ((-FLANK_FAR, -FLANK_NEAR), (FLANK_NEAR, FLANK_FAR))]
    if here is None or None in sides or min(sides) < LEAST_INK:
        return 0.0
    flank = sum(sides) / 2
    return float(np.clip(abs(here - flank) / flank, 0.0, 1.0))


def best_split(ink: np.ndarray) -> tuple[float, float]:
    """(score, place) of the best split; the first of equal ones."""
    if len(ink) < LEAST_SIZE:
        return 0.0, 0.5
    found, at = (0.0, 0.5), SPLIT_FROM
    while at <= SPLIT_TO + 1e-9:
        score = split_score(ink, at)
        if score > found[0]:
            found = (score, at)
        at += SPLIT_STEP
    return found


def classify(gray: np.ndarray) -> tuple[str, float, float]:
    """(class, confidence, split) of a gray page image."""
    dark = gray < INK
    vertical, at = best_split(dark.mean(0))
    horizontal, _ = best_split(dark.mean(1))
    upright = gray.shape[1] / gray.shape[0] <= WIDE
    if vertical >= SURE and horizontal >= SURE and upright:
        return "4_2x2", min(vertical, horizontal), 0.5
    if vertical >= SURE:
        return "2_lr", vertical, at
    if horizontal >= SURE and upright:
        return "uncertain", horizontal, 0.5
    most = max(vertical, horizontal)
    return ("one", 1.0 - most, 0.5) if most < NONE else ("uncertain", most, 0.5)


def page_class(pixels: Column | str, width: Column | str, height: Column | str) -> Column:
    """(class, confidence, split) of images given as arrays of gray values, row by row."""

    @F.pandas_udf("struct<`class`:string,confidence:double,split:double>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for px, w, h in parts:
            yield pd.DataFrame([classify(np.asarray(p).reshape(y, x)) for p, x, y in zip(px, w, h, strict=True)], columns=["class", "confidence", "split"])

    return run(col(pixels), col(width), col(height))


def split_of(ink: Column | str) -> Column:
    """(score, split) of an ink projection."""

    @F.pandas_udf("struct<score:double,split:double>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_split(np.asarray(x, float)) for x in s], columns=["score", "split"])

    return run(col(ink))
