"""Turning and splitting of page images in one pass: pixels stay where they are decoded, only rows leave.

The evidence is staged as in `operators.detection`: the orientation reader looks at the whole image, then at half-size
patches until one is sure, then a model is asked; a broad page is asked about as a spread.  Each stage sees only what the
one before left open, and a backend that isn't there decides nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .. import backends
from ..config import ANGLES, PipelineConfig
from ..functions.replies import angle_of_reply, spread_of_reply
from ..functions.strings import reading_of
from ..schema import IMAGE
from .images import gutter_of, packed, pixels, resized, turned


def views(array: np.ndarray, key: str, most: int, scale: float = 0.5) -> Iterator[np.ndarray]:
    """The whole image, then up to `most` patches of half its size, at places that repeat with the key."""
    yield array
    h, w = int(array.shape[0] * scale), int(array.shape[1] * scale)
    if h < 1 or w < 1:
        return
    rng = np.random.default_rng(zlib.crc32(key.encode("utf-8", "replace")))
    for _ in range(most):
        y, x = int(rng.integers(0, array.shape[0] - h + 1)), int(rng.integers(0, array.shape[1] - w + 1))
        yield array[y : y + h, x : x + w]


def angle_of(array: np.ndarray, key: str, read: Callable | None, ask: Callable | None, config: PipelineConfig) -> tuple[int, str]:
    """(angle, what told it): `page`, `patch`, `model` or `none`; angles that are no quarter turns count as 0."""
    if read is not None:
        for k, view in enumerate(views(array, key, config.max_patches)):
            try:
                angle, confidence = reading_of(read(packed(view)))
            except Exception:  # a reader that fails on a view says nothing about it
                continue
            if angle is not None and confidence is not None and confidence > config.min_confidence:
                return angle if angle in ANGLES else 0, "page" if k == 0 else "patch"
    if ask is not None:
        try:
            return angle_of_reply(ask(packed(resized(array, config.rotation_side)), "rotation")), "model"
        except Exception:
            pass
    return 0, "none"


def is_spread(array: np.ndarray, ask: Callable | None, config: PipelineConfig) -> bool:
    """Whether a broad image shows two pages; upright ones aren't asked about, and a failure means no."""
    if ask is None or array.shape[0] >= array.shape[1]:
        return False
    try:
        return spread_of_reply(ask(packed(resized(array, config.split_side)), "spread"))
    except Exception:
        return False


def prepared(pages: DataFrame, reader: str = "", rotation: str = "", spread: str = "", config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(page_key, stem, page_num, crop_idx, image, rotated, composite, angle, tier) of (page_key, stem, page_num, image).

    Backends go by their registered names.  One narrow pass: each image is decoded once and no image is shuffled.
    """
    makers = [backends.found(backends.READERS, reader), backends.found(backends.MODELS, rotation), backends.found(backends.MODELS, spread)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [make() if make else None for make in makers]
        read = made[0].read if made[0] else None
        ask_angle, ask_spread = (m.ask if m else None for m in made[1:])
        try:
            for batch in batches:
                rows = []
                for key, stem, number, image in zip(batch.page_key, batch.stem, batch.page_num, batch.image):
                    before = pixels(image)
                    angle, tier = angle_of(before, key, read, ask_angle, config)
                    after = turned(before, angle)
                    moved = before.shape != after.shape or not np.array_equal(before, after)
                    parts = [after]
                    if composite := after.shape[1] > 1 and is_spread(after, ask_spread, config):
                        cut = min(max(gutter_of(after, *config.band), 1), after.shape[1] - 1)
                        parts = [after[:, :cut], after[:, cut:]]
                    rows += [(key, stem, number, k, packed(part), moved, composite, angle, tier) for k, part in enumerate(parts)]
                yield pd.DataFrame(rows, columns=["page_key", "stem", "page_num", "crop_idx", "image", "rotated", "composite", "angle", "tier"])
        finally:
            for backend in made:
                if backend is not None and hasattr(backend, "unload"):
                    backend.unload()

    schema = f"page_key string, stem string, page_num int, crop_idx int, image {IMAGE}, rotated boolean, composite boolean, angle int, tier string"
    return pages.select("page_key", "stem", "page_num", "image").mapInPandas(run, schema)
