"""Writers with exact file names, and reports.

The canonical sink is Parquet.  Files with names of their own are written by the tasks, each row to its own file, into
a folder that all executors share.
"""

from __future__ import annotations

import os
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import list_cell
from ..operators.documents import merged_documents, page_blocks
from ..operators.images import outlined, packed, pixels, png
from ..operators.pages import doc_stem, page_key
from ..schema import IMAGE


def write_named(rows: DataFrame, folder: str) -> None:
    """Writes (name, content) rows as UTF-8 files below a folder; a name may have folders; a repeated name is overwritten."""

    def run(part) -> None:
        for row in part:
            path = os.path.join(folder, row["name"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            beside = f"{path}.{os.getpid()}.part"
            with open(beside, "w", encoding="utf-8", newline="") as file:
                file.write(row["content"] or "")
            os.replace(beside, path)  # a task that runs twice leaves one whole file

    rows.select("name", "content").foreachPartition(run)


def write_images(rows: DataFrame, folder: str) -> None:
    """Writes (name, image) rows as lossless image files below a folder; `.png` takes the place of another suffix."""

    def run(part) -> None:
        for row in part:
            path = os.path.join(folder, os.path.splitext(row["name"])[0] + ".png")
            os.makedirs(os.path.dirname(path), exist_ok=True)
            beside = f"{path}.{os.getpid()}.part"
            with open(beside, "wb") as file:
                file.write(png(row["image"].asDict()))
            os.replace(beside, path)

    rows.select("name", "image").foreachPartition(run)


def step_images(crops: DataFrame, step: str) -> DataFrame:
    """(name, image) of debug images `<stem>_page_NN_<step>` of (stem, page_num, crop_idx, image); later crops bear their number."""
    name = F.when(F.col("crop_idx") == 0, F.lit(step)).otherwise(F.concat(F.lit(f"{step}_"), F.col("crop_idx")))
    return crops.select(F.concat(page_key(F.col("stem"), F.col("page_num")), F.lit("_"), name, F.lit(".png")).alias("name"), "image")


def split_images(crops: DataFrame) -> DataFrame:
    """(name, image) of split pages (stem, crop_idx, composite, image): numbered only where a page was split."""
    suffix = F.when(F.col("composite"), F.format_string("_page_%d", F.col("crop_idx") + 1)).otherwise("")
    return crops.select(F.concat("stem", suffix, F.lit(".png")).alias("name"), "image")


def overlays(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """(name, image) of pages (page_key, image) with their regions' boxes drawn on them."""
    found = regions.groupBy("page_key").agg(F.collect_list("bbox").alias("boxes"))

    def run(batches):
        for batch in batches:
            drawn = [packed(outlined(pixels(i), [(b["x0"], b["y0"], b["x1"], b["y1"]) for b in (x if x is not None else ())])) for i, x in zip(batch.image, batch.boxes)]
            yield pd.DataFrame({"name": batch.page_key + "_boxes.png", "image": drawn})

    return pages.select("page_key", "image").join(found, "page_key", "left").mapInPandas(run, f"name string, image {IMAGE}")


def region_images(regions: DataFrame) -> DataFrame:
    """(name, image) of each region's crop: `<page_key>/<region_id>.png`."""
    return regions.select(F.concat("page_key", F.lit("/"), "region_id", F.lit(".png")).alias("name"), "image")


def page_files(pages: DataFrame, text: str = "text") -> DataFrame:
    """(name, content): `<stem>/<page_key>.md` for each page."""
    return pages.select(F.concat(doc_stem(F.col("page_key")), F.lit("/"), "page_key", F.lit(".md")).alias("name"), F.col(text).alias("content"))


def merged_files(pages: DataFrame, text: str = "text", lexicographic: bool = False) -> DataFrame:
    """(name, content): `<stem>_complete.md` for each document."""
    return merged_documents(pages, text, lexicographic).select(F.concat("stem", F.lit("_complete.md")).alias("name"), F.col("document").alias("content"))


def write_merged(pages: DataFrame, folder: str, text: str = "text", lexicographic: bool = False) -> None:
    """Writes `<stem>_complete.md` of each document page by page, so that a document of any size needs no more memory than a page.

    Pages are sorted by document within each task, on disk where need be; a task that runs twice writes its files anew.
    """
    rows = page_blocks(pages, text, lexicographic).repartition("stem").sortWithinPartitions("stem", "o")

    def run(part) -> None:
        os.makedirs(folder, exist_ok=True)
        for stem, own in groupby(part, key=lambda row: row["stem"]):
            path = os.path.join(folder, f"{stem}_complete.md")
            beside = f"{path}.{os.getpid()}.part"
            with open(beside, "w", encoding="utf-8", newline="") as file:
                file.write(f"# Document: {stem}\n\n")
                for row in own:
                    file.write(row["t"])
            os.replace(beside, path)

    rows.foreachPartition(run)


def wiped(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of an earlier run, on any file system; a missing one is fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_transcriptions(pages: DataFrame, folder: str) -> None:
    """Writes the files of `transcription_files` into a folder that is wiped first."""
    wiped(pages.sparkSession, folder)
    write_named(transcription_files(pages), folder)


def transcription_files(pages: DataFrame) -> DataFrame:
    """(name, content): `<stem>/Page_NN.md` of (stem, page_num, text)."""
    return pages.select(F.format_string("%s/Page_%02d.md", "stem", "page_num").alias("name"), F.col("text").alias("content"))


def split_names(rows: DataFrame) -> DataFrame:
    """(original_file, part, name) of (original_file, pages_output): numbered only where a file was split."""
    stem = F.regexp_replace("original_file", r"\.[^.]+$", "")
    parts = rows.select("original_file", "pages_output", F.explode(F.sequence(F.lit(1), F.col("pages_output"))).alias("part"))
    suffix = F.when(F.col("pages_output") > 1, F.format_string("_page_%d", "part")).otherwise("")
    return parts.select("original_file", "part", F.concat(stem, suffix, F.lit(".jpg")).alias("name"))


def debug_report(meta: DataFrame, audit: DataFrame) -> DataFrame:
    """One row for each page's metadata with what was removed; pages that failed keep their row with `None`."""
    removed = audit.select("page_key", "redacted_entities")
    rows = meta.join(removed, "page_key", "left")
    return rows.select(F.col("stem").alias("Filename"), F.col("page").alias("Page"), F.col("rotated").alias("Rotated"), F.col("composite").alias("Composite Image"), list_cell(F.col("redacted_entities")).alias("De-id Info Removed"))


def write_csv(rows: DataFrame, path: str) -> None:
    """One CSV with a header; for reports whose size a person can read."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def leak_report(leaks: DataFrame) -> DataFrame:
    return leaks.select(F.col("page_key").alias("Page"), F.col("leaked_phi").alias("Leaked_PHI"), F.col("context").alias("Context_Surrounding_Leak"))


def preprocess_log(results: DataFrame, path: str) -> None:
    """The per-file log as JSON lines; absent fields of failed files are left out."""
    results.write.mode("overwrite").json(path)


def step_name(stem, page, step: str):
    """The name of a debug image: `<stem>_page_NN_<step>.jpg`."""
    return F.concat(page_key(stem, page), F.lit(f"_{step}.jpg"))
