"""Layout regions: numbering, suppression of swallowed boxes, paragraphs, strips.

Everything runs within a page; a page's boxes are one bounded array, never a join of all boxes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import area, covered

BAND = 40


def region_ids(regions: DataFrame, by: list[Column], form: str, name: str = "region_id", with_label: bool = True) -> DataFrame:
    """Ids numbered within a page in the given total order; `form` is a format for the number (and the label)."""
    number = F.row_number().over(Window.partitionBy("page_key").orderBy(*by)) - 1
    parts = [number.cast("int"), F.col("label")] if with_label else [number.cast("int")]
    return regions.withColumn(name, F.format_string(form, *parts))


def reading_order(b: Column) -> list[Column]:
    """Bands of 40 pixels from the top, then from the left."""
    return [F.floor(b["y0"].cast("int") / BAND), b["x0"]]


def survivors(boxes: Column, swallowed: float = 0.85) -> Column:
    """The boxes (idx, x0, y0, x1, y1) not swallowed by a larger survivor, largest first.

    Ties in area keep their idx order; boxes without area are dropped; a box that lies to more than `swallowed` of its
    own area in a survivor goes.
    """
    largest = F.array_sort(F.filter(boxes, lambda b: area(b) > 0), lambda a, b: F.when(area(a) == area(b), a["idx"] - b["idx"]).otherwise(F.when(area(a) > area(b), -1).otherwise(1)))
    return F.aggregate(largest, F.filter(boxes, lambda b: F.lit(False)), lambda kept, b: F.when(F.exists(kept, lambda k: covered(b, k) > F.lit(swallowed)), kept).otherwise(F.concat(kept, F.array(b))))


def without_swallowed(regions: DataFrame, swallowed: float = 0.85) -> DataFrame:
    """(page_key, idx, x0, y0, x1, y1) of the surviving boxes of each page."""
    boxes = F.array_sort(F.collect_list(F.struct("idx", "x0", "y0", "x1", "y1")))
    kept = regions.groupBy("page_key").agg(boxes.alias("_boxes")).select("page_key", F.explode(survivors(F.col("_boxes"), swallowed)).alias("b"))
    return kept.select("page_key", "b.idx", "b.x0", "b.y0", "b.x1", "b.y1")


def paragraphs_of(lines: list[tuple[float, float, float, float]], gap: float = 0.5) -> list[list[float]]:
    """Line boxes joined from the top into the first paragraph that takes them.

    A paragraph takes a line that begins at most gap * median height below its end and overlaps it sideways, or lies
    at most a median height beside it.
    """
    lines = sorted(lines, key=lambda b: b[1])
    if not lines:
        return []
    heights = sorted(b[3] - b[1] for b in lines)
    middle = len(heights) // 2
    median = heights[middle] if len(heights) % 2 else (heights[middle - 1] + heights[middle]) / 2
    open_: list[list[float]] = []
    for x0, y0, x1, y1 in lines:
        for p in open_:
            beside = max(p[0] - x1, x0 - p[2])
            if 0 <= y0 - p[3] <= gap * median and beside <= median:
                p[0], p[1], p[2], p[3] = min(p[0], x0), min(p[1], y0), max(p[2], x1), max(p[3], y1)
                break
        else:
            open_.append([x0, y0, x1, y1])
    return open_


def paragraphs(lines: DataFrame, gap: float = 0.5) -> DataFrame:
    """(page_key, paragraph_idx, x0, y0, x1, y1) from line boxes (page_key, idx, x0, y0, x1, y1), in creation order."""

    @F.pandas_udf("array<struct<x0:double,y0:double,x1:double,y1:double>>")
    def merged(pages: pd.Series) -> pd.Series:
        made = ([dict(zip(("x0", "y0", "x1", "y1"), map(float, p))) for p in paragraphs_of([(b["x0"], b["y0"], b["x1"], b["y1"]) for b in page], gap)] for page in pages)
        return pd.Series(list(made))

    page = F.array_sort(F.collect_list(F.struct("idx", "x0", "y0", "x1", "y1")))
    rows = lines.groupBy("page_key").agg(page.alias("_lines")).select("page_key", F.posexplode(merged("_lines")).alias("paragraph_idx", "b"))
    return rows.select("page_key", "paragraph_idx", "b.x0", "b.y0", "b.x1", "b.y1")


def strips(pages: DataFrame, height: int = 800, step: int = 600) -> DataFrame:
    """(page_key, strip_idx, y0, y1): overlapping strips that cover each page's height; none for a page without one."""
    last = F.greatest(F.ceil((F.col("height") - height) / step).cast("int"), F.lit(0))
    rows = pages.where("height > 0").select("page_key", "height", F.explode(F.sequence(F.lit(0), last)).alias("strip_idx"))
    return rows.select("page_key", "strip_idx", (F.col("strip_idx") * step).alias("y0"), F.least(F.col("strip_idx") * step + height, F.col("height")).alias("y1"))
