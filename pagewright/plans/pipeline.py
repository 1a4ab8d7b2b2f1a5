"""The pipeline as a chain of DataFrame transforms: load, orient, split, transcribe, redact, report, write.

Nothing is gathered on the driver, and no stage waits for the whole corpus of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import backends, engines  # noqa: F401  (engines register themselves)
from ..config import TASKS, PipelineConfig
from ..functions.replies import identifiers, is_spread
from ..functions.strings import strip
from ..operators import chunking, detection, documents, images, preprocess, redaction
from ..operators.pages import only_pages
from ..sources.files import load, readable


def oriented_crops(pages: DataFrame, readings: DataFrame | None = None, replies: DataFrame | None = None, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(page_key, crop_idx, image, rotated, composite) of image pages.

    readings: (page_key, patch, angle, confidence) of an orientation reader; replies: (page_key, raw_content) about
    spreads.  Without them pages stay as they are.
    """
    spark = pages.sparkSession
    readings = readings if readings is not None else spark.createDataFrame([], "page_key string, patch int, angle int, confidence double")
    replies = replies if replies is not None else spark.createDataFrame([], "page_key string, raw_content string")
    turn = detection.angles(pages, readings, least=config.min_confidence, most=config.max_patches)
    upright = images.oriented(pages.select("page_key", F.lit(0).alias("crop_idx"), "image").join(turn, "page_key"))
    sizes = upright.select("page_key", "image.height", "image.width")
    spread = detection.spreads(sizes, lambda asked: asked.select("page_key").join(replies, "page_key").select("page_key", is_spread(F.col("raw_content")).alias("is_composite")))
    marked = upright.join(spread, "page_key")
    flags = marked.select("page_key", "rotated", F.col("is_composite").alias("composite"))
    return images.split(marked).join(flags, "page_key")


def transcripts(crops: DataFrame, engine: str) -> DataFrame:
    """(page_key, text): each page's crops read and joined in order."""
    return documents.page_texts(backends.transcribed(crops, engine))


def questions(pages: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(page_key, chunk_idx, start, end, chunk, task, instruction) for the second redaction stage."""
    spans = chunking.stage2_spans(config.stage2_chunk, config.stage2_overlap, config.compat_tail)(F.col("text"))
    return chunking.with_tasks(chunking.chunks(pages, spans), TASKS)


def deidentified(pages: DataFrame, source: backends.ReplySource, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Audit records of (page_key, text): markup off, rules, then the identifiers that the replies list."""
    clean = pages.select("page_key", documents.parsed_text(F.col("text")).alias("text"))
    answers = source.answer(questions(clean, config))
    found = redaction.harvested(answers, identifiers(F.col("raw_content")))
    if config.recogniser:
        clean = redaction.recognised(clean, config.recogniser, config.stage1_chunk)
    entities = F.col("entities") if config.recogniser else None
    return redaction.audit_records(clean.join(found, "page_key", "left"), config, entities)


def run(spark: SparkSession, path: str, engine: str, config: PipelineConfig = PipelineConfig(), source: backends.ReplySource | None = None, skip_deid: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results (page_key, text), metadata, failures) of all image pages below a path.

    Images are decoded, turned, split and read in narrow passes; what is shuffled and kept for results and metadata is the
    crops' texts with their flags.
    """
    backends.transcriber(engine)
    loaded, failed = readable(load(spark, path, dpi=config.render_dpi, pages=list(config.pages) or None))
    pages = only_pages(loaded.where("data_type = 'image' and image is not null"), config.pages, "page_num")
    crops = preprocess.prepared(pages, config.orientation_reader, config.rotation_model, config.spread_model, config)
    read = backends.transcribed(crops, engine, "stem", "page_num", "rotated", "composite")
    text = strip(documents.ordered_text(F.col("crop_idx"), F.col("text"), "\n\n"))
    whole = read.groupBy("page_key", "stem", "page_num").agg(text.alias("text"), F.max("rotated").alias("rotated"), F.max("composite").alias("composite")).persist()
    texts = whole.select("page_key", "text")
    meta = whole.select("page_key", "stem", F.col("page_num").alias("page"), "rotated", "composite")
    if skip_deid:
        return texts, meta.withColumn("removed_info", F.array().cast("array<string>")), failed
    source = source or backends.ReplyTable(spark.createDataFrame([], "page_key string, chunk_idx int, task string, raw_content string"))
    audit = deidentified(texts, source, config)
    removed = audit.select("page_key", F.col("redacted_entities").alias("removed_info"))
    return audit.select("page_key", F.col("final_llm_scrubbed").alias("text")), meta.join(removed, "page_key", "left"), failed
