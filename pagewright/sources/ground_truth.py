"""Known identifiers of pages, from `<page_key>/identifiable_info.json` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import ground_truth_terms

FILE = "identifiable_info.json"


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(page_key, term), one row for each identifier; files that hold no known shape give none."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("url"))
    rows = rows.where(F.col("url").endswith("/" + FILE))
    key = F.url_decode(F.element_at(F.split("url", "/"), -2))
    return rows.select(key.alias("page_key"), F.explode(ground_truth_terms(F.col("value"))).alias("term"))
