"""Queries of the training-data problems: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding, leakage, lookalikes, markup, name_variants, pii, repetition, scan_repair, site_lines, truncation
from .common import current_rows, lexicon, table


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return current_rows(table(spark, folder, "audit_trail"), "clean_ocr")


def _raw_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(page_key, clean_ocr): every different raw_text of a page_key, under the name that the operators read."""
    rows = table(spark, folder, "corpus_dict").where("page_key is not null")
    return rows.select("page_key", F.col("raw_text").alias("clean_ocr")).distinct()


def p1_truncation(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncation(_pages(spark, folder), lexicon(spark, folder))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_truncation(spark, folder).where("cut").select("page_key")


def p1_share(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated_share(p1_truncation(spark, folder))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pii.all_identifiers(spark, folder)


def _scrubbed(spark: SparkSession, folder: str, column: str) -> DataFrame:
    v = pii.vocabulary(spark, folder)
    pages = current_rows(table(spark, folder, "audit_trail"), column)
    return pii.scrubbed(pages, v, pii.fitted(spark, folder, v), column)


def p2_scrubbed(spark: SparkSession, folder: str) -> DataFrame:
    return _scrubbed(spark, folder, "clean_ocr")


def p2_rescrubbed(spark: SparkSession, folder: str) -> DataFrame:
    return _scrubbed(spark, folder, "final_llm_scrubbed")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetitive_pages(_pages(spark, folder))


def p3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition(_pages(spark, folder))


def _printed(spark: SparkSession, folder: str) -> DataFrame:
    return site_lines.printed_lines(_pages(spark, folder), table(spark, folder, "audit_trail").select("page_key", "clean_ocr"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _printed(spark, folder).select("page_key", "line_no")


def p4_clean(spark: SparkSession, folder: str) -> DataFrame:
    return site_lines.without_lines(_pages(spark, folder), _printed(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return scan_repair.scan_faults(_pages(spark, folder), lexicon(spark, folder))


def p5_repaired(spark: SparkSession, folder: str) -> DataFrame:
    every = table(spark, folder, "audit_trail").select("page_key", "clean_ocr")
    return scan_repair.repaired_pages(_pages(spark, folder), every, lexicon(spark, folder))


def p5_repaired_raw(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw_texts(spark, folder)
    return scan_repair.repaired_pages(raw, raw, lexicon(spark, folder))


def p6_variants(spark: SparkSession, folder: str) -> DataFrame:
    return name_variants.variants(table(spark, folder, "patient_data_extractor"), table(spark, folder, "audit_trail"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_variants.variant_pairs(p6_variants(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    pages, corpus = _pages(spark, folder), table(spark, folder, "corpus_dict")
    return markup.markup_kinds(pages, corpus, markup.fitted(pages, corpus))


def p7_clean(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder)
    return markup.clean_pages(pages, markup.fitted(pages, table(spark, folder, "corpus_dict")))


def p7_clean_raw(spark: SparkSession, folder: str) -> DataFrame:
    model = markup.fitted(_pages(spark, folder), table(spark, folder, "corpus_dict"))
    return markup.clean_pages(_raw_texts(spark, folder), model)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encoded(_documents(spark, folder))


def p9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(_documents(spark, folder), table(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_leaks(spark, folder).select("doc_id", "item_id").distinct()


def p9_clean(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.without_leaks(_documents(spark, folder), p9_leaks(spark, folder))


def p10_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.canonical(_documents(spark, folder)).select("doc_id", F.col("form").alias("text"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.look_alike_pairs(_documents(spark, folder))


QUERIES = {name: f for name, f in list(globals().items()) if name[:1] == "p" and name[1:2].isdigit()}
