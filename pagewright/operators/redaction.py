"""Two-stage redaction: spans of entities are cut out, then words of harvested identifiers are replaced."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import backends
from ..config import MASK, PipelineConfig
from ..functions.strings import BOUNDARY, is_identifier_word, split_words
from .chunking import blank_spans

#: The rule backend's entities.  Patterns without look-around, so that other SQL engines read them alike.
RULES = (
    ("EMAIL", r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ID", r"[A-Z]{2}[ -]?[0-9]{2}[ -]?[0-9]{2}[ -]?[0-9]{2}[ -]?[A-D]"),
    ("POSTCODE", r"[A-Z]{1,2}[0-9]{1,2} [0-9][A-Z]{2}"),
    ("DATE", r"[0-9]{2}/[0-9]{2}/[0-9]{4}"),
)


def label_of(entity: Column) -> Column:
    """entity_group, else entity, else empty."""
    return F.coalesce(entity["entity_group"], entity["entity"], F.lit(""))


def removable(entities: Column) -> Column:
    """Entities (label, start, end) but those whose label speaks of a date."""
    return F.filter(entities, lambda e: ~F.upper(e["label"]).contains("DATE"))


def rule_entities(text: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Entities found by rules, in text order: array<struct<label,start,end>> with 0-based offsets in code points.

    Where rules overlap, the alternative that stands first in the list wins, as in one alternated pattern.
    """
    whole = "|".join(f"(?:{p})" for _, p in rules)
    found = F.regexp_extract_all(text, F.lit(f"({whole})"), 1)
    label = F.lit("")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<label:string,start:int,end:int>>)").alias("found"))

    def kind(surface: Column) -> Column:
        chosen = label
        for name, pattern in reversed(rules):
            chosen = F.when(surface.rlike(f"^(?:{pattern})$"), name).otherwise(chosen)
        return chosen

    def place(state: Column, surface: Column) -> Column:
        at = (F.call_function("locate", surface, text, state["at"] + 1) - 1).cast("int")
        end = (at + F.length(surface)).cast("int")
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(kind(surface).alias("label"), at.alias("start"), end.alias("end")))).alias("found"))

    return F.aggregate(found, start, place, lambda s: s["found"])


def offset_entities(entities: Column, start: Column) -> Column:
    """Entities of a chunk with the offsets of its page."""
    return F.transform(entities, lambda e: F.struct(e["label"].alias("label"), (e["start"] + start).cast("int").alias("start"), (e["end"] + start).cast("int").alias("end")))


def recognised(pages: DataFrame, name: str, size: int = 1500) -> DataFrame:
    """(page_key, text, entities): a recogniser's entities in each page's chunks, with the offsets of the page.

    Offsets of chunks overlap nowhere, so the entities of a page don't either.  The backend is made once for each task.
    """
    make = backends.found(backends.RECOGNISERS, name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make()
        for batch in batches:
            out = []
            for text in batch.text:
                spans = blank_spans(text or "", size)
                told = engine.entities([text[a:b] for a, b in spans]) if spans else []
                out.append([{"label": label, "start": a + start, "end": a + end} for (a, _), own in zip(spans, told) for label, start, end in own])
            yield pd.DataFrame({"page_key": batch.page_key, "text": batch.text, "entities": out})

    return pages.select("page_key", "text").mapInPandas(run, "page_key string, text string, entities array<struct<label:string,start:int,end:int>>")


def spliced(text: Column, entities: Column) -> Column:
    """struct(text, removed): the spans replaced by the mask from right to left, and their surfaces in that order."""
    backwards = F.array_sort(entities, lambda a, b: b["start"] - a["start"])
    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("removed"))

    def cut(state: Column, e: Column) -> Column:
        before, after = F.substring(state["text"], F.lit(1), e["start"]), F.substring(state["text"], e["end"] + 1, F.length(state["text"]))
        surface = F.substring(text, e["start"] + 1, e["end"] - e["start"])
        return F.struct(F.concat(before, F.lit(MASK), after).alias("text"), F.concat(state["removed"], F.array(surface)).alias("removed"))

    return F.aggregate(backwards, start, cut)


def identifier_words(identifiers: Column, safe: tuple[str, ...]) -> Column:
    """The removable words of harvested identifiers, each once, longest first and then in alphabetical order."""
    words = F.array_distinct(F.flatten(F.transform(F.coalesce(identifiers, F.array().cast("array<string>")), lambda x: split_words(F.coalesce(x, F.lit(""))))))
    kept = F.filter(words, lambda w: is_identifier_word(w, safe))
    return F.transform(F.array_sort(F.transform(kept, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda x: x["w"])


def words_replaced(text: Column, words: Column) -> Column:
    """struct(text, removed): each word replaced where it stands whole, in any case; removed lists the words found."""
    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("removed"))

    def one(state: Column, word: Column) -> Column:
        pattern = F.concat(F.lit(f"(?iu){BOUNDARY}\\Q"), F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(f"\\E{BOUNDARY}"))
        new = F.regexp_replace(state["text"], pattern, F.lit(MASK))
        return F.when(F.rlike(state["text"], pattern), F.struct(new.alias("text"), F.concat(state["removed"], F.array(word)).alias("removed"))).otherwise(state)

    return F.aggregate(words, start, one)


def harvested(replies: DataFrame, identifiers: Column, key: str = "page_key") -> DataFrame:
    """(page_key, identifiers): the distinct identifiers of all accepted replies of a page, sorted.

    Distinct pairs are formed before they are gathered, so repeated replies of a page don't grow its list.
    """
    pairs = replies.select(key, F.explode(identifiers).alias("identifier")).where("identifier is not null").distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list("identifier")).alias("identifiers"))


def audit_records(pages: DataFrame, config: PipelineConfig = PipelineConfig(), entities: Column | None = None) -> DataFrame:
    """(page_key, clean_ocr, roberta_only, final_llm_scrubbed, redacted_entities) of (page_key, text, identifiers) rows.

    Pages whose text is blank get three empty texts and an empty list.  Entities come from the rule backend unless
    given as a column over `text`.  No shuffle: both stages are folds over columns of the row.
    """
    blank = F.coalesce(F.regexp_replace("text", r"\s+", "") == "", F.lit(True))
    one = pages.withColumn("_one", spliced(F.col("text"), removable(entities if entities is not None else rule_entities(F.col("text")))))
    two = one.withColumn("_two", words_replaced(F.col("_one.text"), identifier_words(F.col("identifiers"), config.safe_words)))
    removed = F.array_sort(F.array_distinct(F.concat("_one.removed", "_two.removed")))
    none = F.array().cast("array<string>")
    return two.select(
        "page_key",
        F.when(blank, "").otherwise(F.col("text")).alias("clean_ocr"),
        F.when(blank, "").otherwise(F.col("_one.text")).alias("roberta_only"),
        F.when(blank, "").otherwise(F.col("_two.text")).alias("final_llm_scrubbed"),
        F.when(blank, none).otherwise(removed).alias("redacted_entities"),
    )
