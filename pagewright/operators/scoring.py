"""Scoring a redaction against known identifiers: hits, misses, over-redaction, leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import spellings
from ..functions.strings import context, word_tokens


def ground_truth_terms(raw: Column) -> Column:
    """The identifiers of a ground-truth JSON text, as an array; null if it is no JSON of a known shape.

    Shapes: {"ID": list or scalar}, an object whose text fields count, and a list of {"ID": value}.
    """
    parsed = F.try_parse_json(raw)
    listed = F.try_variant_get(parsed, "$.ID", "array<string>")
    single = F.try_variant_get(parsed, "$.ID", "string")
    rows = F.try_variant_get(parsed, "$", "array<struct<ID:string>>")
    fields = F.from_json(raw, "map<string,string>")
    kinds = F.schema_of_variant(parsed)
    of_rows = F.filter(F.transform(rows, lambda r: r["ID"]), lambda x: x.isNotNull())
    texts = F.try_variant_get(parsed, "$", "map<string,variant>")
    plain = F.map_values(F.map_filter(fields, lambda k, v: F.schema_of_variant(texts[k]) == "STRING"))
    has_id = F.try_variant_get(parsed, "$.ID", "variant").isNotNull()
    return F.when(kinds.startswith("ARRAY"), of_rows).when(has_id & listed.isNotNull(), listed).when(has_id, F.array(single)).when(kinds.startswith("OBJECT"), plain)


def page_terms(terms: DataFrame) -> DataFrame:
    """(page_key, term), lower case, distinct; null and empty terms are dropped."""
    return terms.select("page_key", F.lower("term").alias("term")).where("term is not null and term != '' and page_key is not null").distinct()


def exact_targets(pages: DataFrame, terms: DataFrame) -> DataFrame:
    """(page_key, target, clean, final): terms that stand in the page's original text.

    pages: (page_key, clean_ocr, final_llm_scrubbed); both texts are lower-cased.  The join is on the page, so a term
    meets its own page only.
    """
    texts = pages.select("page_key", F.lower(F.coalesce("clean_ocr", F.lit(""))).alias("clean"), F.lower(F.coalesce("final_llm_scrubbed", F.lit(""))).alias("final"))
    return texts.join(page_terms(terms), "page_key").where(F.contains("clean", "term")).withColumnRenamed("term", "target")


def fuzzy_targets(pages: DataFrame, terms: DataFrame, cutoff: float = 0.85, most: int = 5) -> DataFrame:
    """The same with every spelling of a term that the original text has, by Ratcliff-Obershelp similarity."""
    texts = pages.select("page_key", F.lower(F.coalesce("clean_ocr", F.lit(""))).alias("clean"), F.lower(F.coalesce("final_llm_scrubbed", F.lit(""))).alias("final"))
    met = texts.join(page_terms(terms), "page_key").withColumn("words", word_tokens(F.col("clean")))
    found = met.withColumn("target", F.explode(spellings(cutoff, most)("term", "clean", "words")))
    return found.select("page_key", "target", "clean", "final").distinct()


def scores(pages: DataFrame, terms: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_key, tp, fn, fp, tn) of each page that has ground truth (a semi join; pages without are not scored).

    tp, fn: targets that went from the redacted text, and that stay.  fp: distinct words that went but belong to no
    target; tn: the other words that belong to none, at least 0.  A page's targets are gathered once and everything is
    counted in its row, so targets are made once and all steps share the partitioning by page.
    """
    listed = targets.groupBy("page_key").agg(F.collect_set("target").alias("targets"))
    known = pages.join(page_terms(terms).select("page_key").distinct(), "page_key", "left_semi")
    none = F.array().cast("array<string>")
    texts = known.select("page_key", F.lower(F.coalesce("clean_ocr", F.lit(""))).alias("clean"), F.lower(F.coalesce("final_llm_scrubbed", F.lit(""))).alias("final"))
    full = texts.join(listed, "page_key", "left").withColumn("targets", F.coalesce("targets", none))
    words = full.select(
        "page_key",
        F.size("targets").alias("n_targets"),
        F.size(F.filter("targets", lambda t: F.contains(F.col("final"), t))).alias("left"),
        F.array_distinct(word_tokens(F.col("clean"))).alias("before"),
        F.array_distinct(word_tokens(F.col("final"))).alias("after"),
        F.array_distinct(F.flatten(F.transform("targets", word_tokens))).alias("expected"),
    )
    fp = F.size(F.array_except(F.array_except("before", "after"), "expected"))
    counts = words.select("page_key", "n_targets", "left", fp.alias("fp"), F.size("before").alias("n_before"), F.size("expected").alias("n_expected"))
    tn = F.greatest(F.lit(0), F.col("n_before") - F.col("n_expected") - F.col("fp"))
    return counts.select("page_key", (F.col("n_targets") - F.col("left")).cast("long").alias("tp"), F.col("left").cast("long").alias("fn"), F.col("fp").cast("long").alias("fp"), tn.cast("long").alias("tn"))


def rate(part: Column, rest: Column) -> Column:
    """part / (part + rest) in per cent; 0.0 where both are 0."""
    return F.when(part + rest > 0, F.try_divide(part * 100.0, (part + rest).cast("double"))).otherwise(F.lit(0.0))


def scorecard(per_page: DataFrame) -> DataFrame:
    """One row: summed counts with sensitivity and specificity, micro-averaged over pages."""
    total = per_page.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fn", "fp", "tn")])
    return total.select("*", rate(F.col("tp"), F.col("fn")).alias("sensitivity"), rate(F.col("tn"), F.col("fp")).alias("specificity"))


def leaks(targets: DataFrame, around: int = 35) -> DataFrame:
    """(page_key, leaked_phi, context): targets that still stand in the redacted text, with what stands around them."""
    left = targets.where(F.contains("final", "target"))
    return left.select("page_key", F.col("target").alias("leaked_phi"), context(F.col("final"), F.col("target"), around).alias("context"))
