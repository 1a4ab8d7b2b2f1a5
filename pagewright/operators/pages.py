"""Keys, routing and filters of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EMPTY_LABELS, IMAGE_TYPES, PDF_TYPES, TEXT_TYPES


def page_key(stem: Column, page: Column) -> Column:
    """`<stem>_page_<page>` with at least two digits."""
    return F.format_string("%s_page_%02d", stem, page)


def doc_stem(key: Column) -> Column:
    """What stands before the last `_page_`; the whole key where there is none."""
    return F.when(key.contains("_page_"), F.regexp_extract(key, r"(?s)^(.*)_page_", 1)).otherwise(key)


def extension(filename: Column) -> Column:
    """The last suffix in lower case with its dot; empty for names without one or that begin with their only dot."""
    return F.lower(F.regexp_extract(filename, r"[^.](\.[^.]+)$", 1))


def file_stem(filename: Column) -> Column:
    return F.when(filename.rlike(r"[^.]\.[^.]+$"), F.regexp_extract(filename, r"(?s)^(.*)\.[^.]+$", 1)).otherwise(filename)


def family(ext: Column) -> Column:
    """`pdf`, `image` or `text`; null for files that are left out."""
    return F.when(ext.isin(*PDF_TYPES), "pdf").when(ext.isin(*IMAGE_TYPES), "image").when(ext.isin(*TEXT_TYPES), "text")


def routed(files: DataFrame, name: str = "filename") -> DataFrame:
    """Adds stem, extension and family; files of unknown families are dropped."""
    ext = extension(F.col(name))
    return files.withColumns({"stem": file_stem(F.col(name)), "extension": ext, "family": family(ext)}).where(F.col("family").isNotNull())


def numbered(rows: DataFrame, within: list[str], by: list[Column], name: str = "page_num") -> DataFrame:
    """1-based ordinals of the rows of each group; `by` must order them totally."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*by)))


def page_filter(text: str | None) -> list[int] | None:
    """The page numbers of a list such as `1,3,5`; None keeps all pages; a malformed list raises ValueError."""
    if text is None or not text.strip():
        return None
    return [int(x) for x in text.split(",")]


def only_pages(rows: DataFrame, pages: list[int] | tuple[int, ...] | None, column: str = "page") -> DataFrame:
    return rows.where(F.col(column).isin(*pages)) if pages else rows


def last_written(rows: DataFrame, key: str = "page_key", by: str = "written_at", fields: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the one written last, ties broken by the fields' values, partially aggregated before the shuffle."""
    fields = fields or tuple(c for c in rows.columns if c != key)
    order = (by, *[f for f in fields if f != by])
    newest = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order)).alias("_newest"))
    return newest.select(key, *[F.col(f"_newest.{f}").alias(f) for f in fields])


def without_empty_labels(regions: DataFrame) -> DataFrame:
    """Content regions; ids were given before, so they keep their gaps."""
    return regions.where(~F.col("label").isin(*EMPTY_LABELS))
