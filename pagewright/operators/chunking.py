"""Cutting page texts into chunks for models."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int>>"


def blank_spans(text: str, size: int) -> list[tuple[int, int]]:
    """Chunks of at most `size` characters that end before a blank; the next one begins at that blank.

    A chunk without a blank after its first character is cut hard, so every step advances.
    """
    spans, at, end = [], 0, len(text)
    while at < end:
        stop = min(at + size, end)
        if stop < end:
            blank = text.rfind(" ", at, stop)
            if blank > at:
                stop = blank
        spans.append((at, stop))
        at = stop
    return spans


def overlapping_spans(text: str, size: int, overlap: int, tail: bool = False) -> list[tuple[int, int]]:
    """Chunks that end at a blank, line end, full stop or comma and share `overlap` characters with the next.

    A cut that would not leave the overlap behind is made hard.  A last chunk that the one before covers is left out
    unless `tail`.
    """
    spans, at, end = [], 0, len(text)
    while at < end:
        stop = at + size
        if stop < end:
            cut = max(text.rfind(c, at + 1, stop + 1) for c in " \n.,")
            stop = cut if cut - at > overlap else stop
        elif not tail:
            spans.append((at, end))
            break
        spans.append((at, min(stop, end)))
        at = stop - overlap
    return spans


def stage1_spans(size: int = 1500):
    @F.pandas_udf(SPAN)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in blank_spans(t or "", size)])

    return run


def stage2_spans(size: int = 1500, overlap: int = 150, tail: bool = False):
    @F.pandas_udf(SPAN)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in overlapping_spans(t or "", size, overlap, tail)])

    return run


def blank_spans_native(text: Column, size: int = 1500) -> Column:
    """`blank_spans` as a fold of built-in expressions: no Python, but interpreted; kept as a cross-check."""
    steps = F.sequence(F.lit(1), 2 * F.ceil(F.length(text) / size).cast("int") + 2)
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("spans"))

    def step(state: Column, _: Column) -> Column:
        at, window = state["at"], F.substring(text, state["at"] + 1, F.lit(size))
        blank = F.length(window) - F.instr(F.reverse(window), " ")
        whole = at + F.length(window)
        stop = F.when((whole < F.length(text)) & (F.instr(F.reverse(window), " ") > 0) & (blank > 0), at + blank).otherwise(whole).cast("int")
        grown = F.concat(state["spans"], F.array(F.struct(at.alias("start"), stop.alias("end"))))
        return F.when(at < F.length(text), F.struct(stop.alias("at"), grown.alias("spans"))).otherwise(state)

    return F.aggregate(steps, start, step, lambda s: s["spans"])


def chunks(pages: DataFrame, spans: Column, text: str = "text", stripped: bool = True) -> DataFrame:
    """(page_key, chunk_idx, start, end, chunk), one row for each span; texts without a span have no row."""
    rows = pages.select("page_key", F.col(text).alias("_text"), F.posexplode(spans).alias("chunk_idx", "_span"))
    piece = F.substring(F.col("_text"), F.col("_span.start") + 1, F.col("_span.end") - F.col("_span.start"))
    piece = F.regexp_replace(piece, r"^\s+|\s+$", "") if stripped else piece
    return rows.select("page_key", "chunk_idx", "_span.start", "_span.end", piece.alias("chunk"))


def with_tasks(chunk_rows: DataFrame, tasks: tuple[tuple[str, str], ...]) -> DataFrame:
    """Each chunk once for each question; the questions are a literal array, so no join is planned."""
    listed = F.array(*[F.struct(F.lit(a).alias("task"), F.lit(b).alias("instruction")) for a, b in tasks])
    return chunk_rows.withColumn("_task", F.explode(listed)).select(*chunk_rows.columns, "_task.task", "_task.instruction")
