"""Queries do the whole job: no row is left out by a bound of the query's own."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.catalog import QUERIES


def test_every_patch_of_a_page(spark, data):
    rows = QUERIES["patch_boxes"](spark, data).groupBy("page_key").agg(F.countDistinct("patch").alias("n"), F.max("patch").alias("last"))
    assert not rows.isEmpty() and rows.where("n != 101 or last != 100").isEmpty()
