"""Model backends: protocols, deterministic defaults, and a registry by name.

Recognition is outside the engine.  A backend is a small object; what the engine does around it is the same for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Transcriber(Protocol):
    """Reads images: one text for each, in order; an unreadable image gives ''."""

    def run(self, images: list[dict]) -> list[str]: ...

    def unload(self) -> None: ...


class ReplySource(Protocol):
    """Answers (page_key, chunk_idx, task, chunk) rows with a raw_content column."""

    def answer(self, questions: DataFrame) -> DataFrame: ...


class SizeTranscriber:
    """Deterministic stand-in: the text tells an image's size; images without pixels give ''."""

    def run(self, images: list[dict]) -> list[str]:
        return [f"{i['width']} x {i['height']}" if i and i["width"] * i["height"] else "" for i in images]

    def unload(self) -> None:
        pass


class ReplyTable:
    """Replies looked up in a table by page, chunk and task; a question without a reply has a null raw_content."""

    def __init__(self, replies: DataFrame):
        self.replies = replies.select("page_key", "chunk_idx", "task", "raw_content")

    def answer(self, questions: DataFrame) -> DataFrame:
        return questions.join(self.replies, ["page_key", "chunk_idx", "task"], "left")


class OrientationReader(Protocol):
    """Reads an image's orientation: a text such as `Rotate: 90` and `Orientation confidence: 7.5`."""

    def read(self, image: dict) -> str: ...


class PageModel(Protocol):
    """Answers a question (`rotation` or `spread`) about an image with a raw reply."""

    def ask(self, image: dict, question: str) -> str: ...


class Detector(Protocol):
    """Finds regions on a page of BGR rows: ((x0, y0, x1, y1), label)."""

    def detect(self, array) -> list[tuple[tuple[int, int, int, int], str]]: ...


class Recogniser(Protocol):
    """Names entities in chunks of text: for each chunk (label, start, end) with offsets in it."""

    def entities(self, chunks: list[str]) -> list[list[tuple[str, int, int]]]: ...


#: Backends by name.  Engines register themselves here; what needs a model isn't part of this package.
TRANSCRIBERS: dict[str, type] = {"size": SizeTranscriber}
READERS: dict[str, type] = {}
MODELS: dict[str, type] = {}
DETECTORS: dict[str, type] = {}
RECOGNISERS: dict[str, type] = {}


def found(registry: dict[str, type], name: str) -> type | None:
    """The registered backend; None for no name; LookupError for an unknown one."""
    if not name:
        return None
    if name not in registry:
        raise LookupError(f"no backend {name!r}; there are {', '.join(sorted(registry)) or 'none'}")
    return registry[name]


def transcriber(name: str) -> type:
    """The registered transcriber; LookupError for an unknown name."""
    if name not in TRANSCRIBERS:
        raise LookupError(f"no transcriber {name!r}; there are {', '.join(sorted(TRANSCRIBERS))}")
    return TRANSCRIBERS[name]


def transcribed(crops: DataFrame, name: str, *keep: str) -> DataFrame:
    """(page_key, crop_idx, *keep, text, duration_ms); the backend is made once for each task and released at its end.

    It gets the crops of an Arrow batch at once, so that an engine can batch them; if that fails, each by itself, and a
    crop that fails alone, or is empty, has an empty text.  Durations are the batch's, shared evenly.
    """
    make = transcriber(name)
    kinds = dict(crops.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        engine = make()
        try:
            for batch in batches:
                began = time.monotonic()
                images = list(batch.image)
                full = [k for k, i in enumerate(images) if i is not None and i["height"] * i["width"] > 0]
                texts = [""] * len(images)
                try:
                    for k, text in zip(full, engine.run([images[k] for k in full]) if full else (), strict=True):
                        texts[k] = text
                except Exception:  # one crop's failure must not lose the others
                    for k in full:
                        try:
                            texts[k] = engine.run([images[k]])[0]
                        except Exception:
                            texts[k] = ""
                took = 1000 * (time.monotonic() - began) / max(1, len(images))
                yield pd.DataFrame({"page_key": batch.page_key, "crop_idx": batch.crop_idx, **{k: batch[k] for k in keep}, "text": texts, "duration_ms": took})
        finally:
            engine.unload()

    kept = "".join(f"{k} {kinds[k]}, " for k in keep)
    return crops.select("page_key", "crop_idx", *keep, "image").mapInPandas(run, f"page_key string, crop_idx int, {kept}text string, duration_ms double")


def cached(questions: DataFrame, known: DataFrame, source: ReplySource, model: str) -> tuple[DataFrame, DataFrame]:
    """(all replies, new ones): only questions whose chunk the model hasn't answered yet go to the source.

    known: (chunk_hash, task, model, raw_content), to which the new ones may be appended.
    """
    asked = questions.withColumn("chunk_hash", F.sha2("chunk", 256)).withColumn("model", F.lit(model))
    keys = ["chunk_hash", "task", "model"]
    open_ = asked.join(known.select(*keys), keys, "left_anti").dropDuplicates(keys)
    new = source.answer(open_).select(*keys, "raw_content")
    return asked.join(known.select(*keys, "raw_content").unionByName(new), keys, "left"), new
