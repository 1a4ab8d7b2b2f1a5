"""Pages and events as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..operators.redaction import audit_records


def stream_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(page_key, text) of text files `<page_key>.txt` as they appear in a folder."""
    rows = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.txt").schema("value string").text(folder)
    name = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"([^/]+)\.[^.]+$", 1)
    return rows.select(name.alias("page_key"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def stream_redacted(spark: SparkSession, folder: str, out: str, checkpoint: str, config: PipelineConfig = PipelineConfig()) -> StreamingQuery:
    """Redacts arriving pages by rules and appends the audit records to a Parquet table; runs until nothing is left."""
    pages = stream_texts(spark, folder).withColumn("identifiers", F.array().cast("array<string>"))
    audit = audit_records(pages, config)
    return audit.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, event_type, n, mean_value): tumbling windows over event time, late rows dropped after `late`.

    Works on a stream and on a table alike.
    """
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.avg("value").alias("mean_value")).select(F.col("w.start").alias("window_start"), "event_type", "n", "mean_value")
