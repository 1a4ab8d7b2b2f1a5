"""Staged decisions: cheap evidence first, and the expensive backend only for what it leaves open."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ANGLES
from ..functions.geometry import patch_origin


def patches(images: DataFrame, most: int = 100, scale: float = 0.5) -> DataFrame:
    """(page_key, patch, x, y, width, height): patch 0 is the whole image, then `most` repeatable patches of half size."""
    w, h = (F.col("width") * scale).cast("int"), (F.col("height") * scale).cast("int")
    rows = images.select("page_key", "width", "height", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("patch"))
    part = F.col("patch") > 0
    x = patch_origin(F.col("page_key"), F.col("patch") * 2, F.col("width") - w)
    y = patch_origin(F.col("page_key"), F.col("patch") * 2 + 1, F.col("height") - h)
    return rows.select("page_key", "patch", F.when(part, x).otherwise(0).alias("x"), F.when(part, y).otherwise(0).alias("y"), F.when(part, w).otherwise(F.col("width")).alias("width"), F.when(part, h).otherwise(F.col("height")).alias("height"))


def first_confident(readings: DataFrame, least: float = 4.0, most: int = 100) -> DataFrame:
    """(page_key, angle, patch): the angle of the first reading (page_key, patch, angle, confidence) that is sure enough.

    min_by is partially aggregated, so a page with very many readings moves one row per task.
    """
    sure = readings.where((F.col("confidence") > least) & (F.col("patch") <= most) & F.col("angle").isNotNull())
    order = F.struct("patch", "angle")
    return sure.groupBy("page_key").agg(F.min(order).alias("f")).select("page_key", "f.angle", "f.patch")


def angles(pages: DataFrame, readings: DataFrame, fallback: Callable[[DataFrame], DataFrame] | None = None, least: float = 4.0, most: int = 100) -> DataFrame:
    """(page_key, angle, tier) of every page: reading of the whole image, of a patch, the fallback's answer, else 0.

    `fallback` gets only the pages that no reading decided and returns (page_key, angle).
    """
    decided = first_confident(readings, least, most)
    known = pages.select("page_key").join(decided, "page_key", "left")
    sure = known.where("angle is not null").select("page_key", "angle", F.when(F.col("patch") == 0, "page").otherwise("patch").alias("tier"))
    open_ = known.where("angle is null").select("page_key")
    if fallback is None:
        rest = open_.select("page_key", F.lit(0).alias("angle"), F.lit("none").alias("tier"))
    else:
        answer = open_.join(fallback(open_).withColumnRenamed("angle", "said"), "page_key", "left")
        rest = answer.select("page_key", F.coalesce("said", F.lit(0)).alias("angle"), F.when(F.col("said").isNull(), "none").otherwise("model").alias("tier"))
    whole = sure.unionByName(rest)
    return whole.withColumn("angle", F.when(F.col("angle").isin(*ANGLES), F.col("angle")).otherwise(0))


def spreads(images: DataFrame, asked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(page_key, is_composite): upright images are no spreads and aren't asked about; the others are."""
    upright = images.where("height >= width").select("page_key", F.lit(False).alias("is_composite"))
    broad = images.where("height < width or height is null or width is null")
    answer = broad.select("page_key").join(asked(broad), "page_key", "left")
    return upright.unionByName(answer.select("page_key", F.coalesce("is_composite", F.lit(False)).alias("is_composite")))
