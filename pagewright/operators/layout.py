"""Layout extractors: what a detector finds becomes numbered, padded regions with their crops.

Detectors are backends; the morphological one is the default and needs none.  The relational halves (`restored`,
`line_regions`, `paragraph_regions`, `block_regions`) work on tables of what detectors said.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import backends
from ..functions import geometry, strings
from ..schema import BOX, IMAGE
from . import boxes
from .images import closed, components, contrasted, dark, grey, packed, pixels
from .pages import without_empty_labels

#: White border around a page whose strips are looked at, and the strips' height and step.
BORDER, STRIP, STEP = 60, 800, 600
#: Smallest part of a page that a block of ink may take, and what is smeared together, in columns and rows.
LEAST_BLOCK, SMEAR = 0.005, (35, 12)


def blocks_of(array: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Boxes of the blocks of ink on a page: dark pixels smeared into blobs, of which small ones are dropped.

    A blob's size is what its outline holds: each row counts from its first to its last pixel.
    """
    found = components(closed(dark(grey(array)), *SMEAR))
    return [box for box, size in found if size >= LEAST_BLOCK * array.shape[0] * array.shape[1]]


class Blocks:
    """The default detector."""

    def detect(self, array: np.ndarray) -> list[tuple[tuple[int, int, int, int], str]]:
        return [(box, "layout_block") for box in blocks_of(array)]


backends.DETECTORS["blocks"] = Blocks


def strips_of(array: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, strip) of a page within a white border, overlapping from the top to the end."""
    framed = np.pad(array, ((BORDER, BORDER), (BORDER, BORDER), (0, 0)), constant_values=255)
    at = 0
    while True:
        yield at, framed[at : at + STRIP]
        if at + STRIP >= framed.shape[0]:
            return
        at += STEP


def squared(array: np.ndarray) -> np.ndarray:
    """The image at the top left of a white square, so that a model doesn't distort it."""
    side = max(array.shape[:2])
    return np.pad(array, ((0, side - array.shape[0]), (0, side - array.shape[1]), (0, 0)), constant_values=255)


def restored(found: DataFrame, border: int = BORDER) -> DataFrame:
    """(page_key, idx, x0, y0, x1, y1, label) from what was found in strips: (page_key, idx, y_offset, strip_width, strip_height, width, height, quad, label).

    quad: x and y of the corners in turn, within the strip.  What lies outside the strip goes; boxes are shifted back to
    the page, clipped to it, and dropped where nothing is left.
    """
    odd = lambda k: F.expr(f"filter(quad, (v, i) -> i % 2 = {k})")
    whole = lambda c: c.cast("int")
    x0, x1 = F.greatest(whole(F.array_min(odd(0))), F.lit(0)), F.least(whole(F.array_max(odd(0))), F.col("strip_width"))
    top, end = whole(F.array_min(odd(1))), whole(F.array_max(odd(1)))
    valid = (x1 > x0) & (F.least(end, F.col("strip_height")) > F.greatest(top, F.lit(0)))
    rows = found.where(valid).select(
        "page_key",
        "idx",
        F.greatest(x0 - border, F.lit(0)).alias("x0"),
        F.greatest(top + F.col("y_offset") - border, F.lit(0)).alias("y0"),
        F.least(x1 - border, F.col("width")).alias("x1"),
        F.least(end + F.col("y_offset") - border, F.col("height")).alias("y1"),
        strings.sanitised_label(F.col("label")).alias("label"),
    )
    return rows.where("x1 > x0 and y1 > y0")


def mined(found: DataFrame) -> DataFrame:
    """The boxes of `restored` that no larger one swallows, with their labels."""
    rows = restored(found)
    return boxes.without_swallowed(rows).join(rows.select("page_key", "idx", "label"), ["page_key", "idx"])


def _padded(pad: int) -> Column:
    return geometry.padded(geometry.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), pad, F.col("width"), F.col("height"))


def _regions(rows: DataFrame, pad: int) -> DataFrame:
    return rows.withColumn("b", _padded(pad)).select("page_key", "region_id", "b.x0", "b.y0", "b.x1", "b.y1").where("x1 > x0 and y1 > y0")


def line_regions(polygons: DataFrame, pad: int = 4) -> DataFrame:
    """(page_key, region_id, x0, y0, x1, y1) of text lines (page_key, idx, points, width, height), numbered by their first corner's height."""
    numbered = boxes.region_ids(polygons, [F.col("points")[0]["y"], F.col("idx")], "line_%03d", with_label=False)
    hull = geometry.hull(F.col("points"))
    return _regions(numbered.withColumn("h", hull).select("page_key", "region_id", "width", "height", "h.x0", "h.y0", "h.x1", "h.y1"), pad)


def paragraph_regions(lines: DataFrame, pad: int = 4) -> DataFrame:
    """The same of lines (page_key, idx, x0, y0, x1, y1, width, height) joined to paragraphs, numbered as these were begun."""
    sizes = lines.groupBy("page_key").agg(F.first("width").alias("width"), F.first("height").alias("height"))
    made = boxes.paragraphs(lines.select("page_key", "idx", "x0", "y0", "x1", "y1")).join(sizes, "page_key")
    return _regions(made.withColumn("region_id", F.format_string("line_%03d", "paragraph_idx")), pad)


def block_regions(blocks: DataFrame, pad: int = 4) -> DataFrame:
    """The same of content blocks (page_key, idx, x0, y0, x1, y1, label, width, height) in reading order, numbered before empty labels go."""
    numbered = boxes.region_ids(blocks, [*boxes.reading_order(F.struct("y0", "x0")), F.col("idx")], "block_%03d", with_label=False)
    return _regions(without_empty_labels(numbered), pad)


def regions(pages: DataFrame, detector: str = "blocks", pad: int = 6, mine: bool = False) -> DataFrame:
    """(page_key, region_idx, region_id, label, bbox, image) of page images (page_key, image), from the top; crops are padded.

    With `mine` the detector looks at strips of the framed page, with more contrast and each on a white square.  One narrow pass.
    """
    make = backends.found(backends.DETECTORS, detector)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make()
        for batch in batches:
            rows = []
            for key, image in zip(batch.page_key, batch.image):
                array = pixels(image)
                h, w = array.shape[:2]
                found = _mined(engine, array) if mine else engine.detect(array)
                for k, ((x0, y0, x1, y1), label) in enumerate(sorted(found, key=lambda f: f[0][1])):
                    x0, y0, x1, y1 = max(0, x0 - pad), max(0, y0 - pad), min(w, x1 + pad), min(h, y1 + pad)
                    if x1 > x0 and y1 > y0:
                        rows.append((key, k, f"region_{k + 1:02d}_{label}", label, {"x0": x0, "y0": y0, "x1": x1, "y1": y1}, packed(array[y0:y1, x0:x1])))
            yield pd.DataFrame(rows, columns=["page_key", "region_idx", "region_id", "label", "bbox", "image"])

    schema = f"page_key string, region_idx int, region_id string, label string, bbox {BOX}, image {IMAGE}"
    return pages.select("page_key", "image").mapInPandas(run, schema)


def _mined(engine, array: np.ndarray) -> list[tuple[tuple[int, int, int, int], str]]:
    """What a detector finds in the strips of a page, on the page; of boxes that swallow each other the largest."""
    h, w = array.shape[:2]
    found = []
    for at, strip in strips_of(array):
        for (x0, y0, x1, y1), label in engine.detect(squared(contrasted(strip))):
            x0, x1, top, end = max(0, x0), min(strip.shape[1], x1), max(0, y0), min(strip.shape[0], y1)
            if x1 > x0 and end > top:
                box = max(0, x0 - BORDER), max(0, y0 + at - BORDER), min(w, x1 - BORDER), min(h, y1 + at - BORDER)
                if box[2] > box[0] and box[3] > box[1]:
                    found.append((box, label))
    kept: list[tuple[tuple[int, int, int, int], str]] = []
    for box, label in sorted(found, key=lambda f: -(f[0][2] - f[0][0]) * (f[0][3] - f[0][1])):
        own = (box[2] - box[0]) * (box[3] - box[1])
        if not any(max(0, min(box[2], k[2]) - max(box[0], k[0])) * max(0, min(box[3], k[3]) - max(box[1], k[1])) > 0.85 * own for k, _ in kept):
            kept.append((box, label))
    return kept
