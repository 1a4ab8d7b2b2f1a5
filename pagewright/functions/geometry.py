"""Boxes and scales.  Boxes are structs x0, y0, x1, y1 of pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), x1.cast("int").alias("x1"), y1.cast("int").alias("y1"))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def shared_area(a: Column, b: Column) -> Column:
    width = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    height = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(width, F.lit(0)) * F.greatest(height, F.lit(0))


def covered(a: Column, b: Column) -> Column:
    """The share of box a that lies in box b; null for a box without area."""
    return F.try_divide(shared_area(a, b).cast("double"), area(a).cast("double"))


def padded(b: Column, pad: int, width: Column, height: Column) -> Column:
    """A box widened on all sides and clipped to its page."""
    return box(F.greatest(F.lit(0), b["x0"] - pad), F.greatest(F.lit(0), b["y0"] - pad), F.least(width, b["x1"] + pad), F.least(height, b["y1"] + pad))


def hull(points: Column) -> Column:
    """The box around an array of structs x, y, cut to whole pixels."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def fitted_size(width: Column, height: Column, side: int) -> tuple[Column, Column]:
    """(width, height) with the longer side at most `side`; smaller images keep theirs."""
    longest = F.greatest(width, height)

    def scaled(x: Column) -> Column:
        return F.when(longest > side, (x * (F.lit(float(side)) / longest)).cast("int")).otherwise(x.cast("int"))

    return scaled(width), scaled(height)


def search_band(width: Column, low: float = 0.40, high: float = 0.60) -> tuple[Column, Column]:
    """First and last-but-one column of the strip in which a gutter is looked for."""
    return (width * F.lit(float(low))).cast("int"), (width * F.lit(float(high))).cast("int")


def gutter(sums: Column, low: float = 0.40, high: float = 0.60, centre: bool = False) -> Column:
    """The column with the least sum in the band: the leftmost of equals, or the one nearest the middle."""
    n = F.size(sums)
    first, end = search_band(n, low, high)
    strip = F.slice(sums, first + 1, F.greatest(end - first, F.lit(1)))
    if not centre:
        return first + F.array_position(strip, F.array_min(strip)).cast("int") - 1
    least = F.array_min(strip)
    places = F.filter(F.transform(strip, lambda x, i: F.struct((x == least).alias("low"), F.abs(first + i - n / 2).alias("away"), (first + i).alias("at"))), lambda x: x["low"])
    return F.array_min(F.transform(places, lambda x: F.struct(x["away"], x["at"])))["at"]


def patch_origin(key: Column, patch: Column, room: Column) -> Column:
    """A repeatable origin of a patch in [0, room], in place of a random one."""
    return F.pmod(F.xxhash64(key, patch), (F.greatest(room, F.lit(0)) + 1).cast("bigint")).cast("int")


def page_scale(dpi: int) -> float:
    """Points are 1/72 inch."""
    return dpi / 72.0
