from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.operators import boxes, detection, images, pages


def brute_survivors(rows, limit=0.85):
    kept = []
    for _, b in sorted(((-(b[3] - b[1]) * (b[4] - b[2]), b[0]), b) for b in rows if (b[3] - b[1]) * (b[4] - b[2]) > 0):
        area = (b[3] - b[1]) * (b[4] - b[2])
        if not any(max(0, min(b[3], k[3]) - max(b[1], k[1])) * max(0, min(b[4], k[4]) - max(b[2], k[2])) / area > limit for k in kept):
            kept.append(b)
    return {b[0] for b in kept}


def test_survivors(spark):
    pages_of = {
        "nested": [(0, 0, 0, 100, 100), (1, 10, 10, 90, 90), (2, 20, 20, 30, 30)],
        "exact": [(0, 0, 0, 100, 100), (1, 85, 0, 105, 100)],
        "at": [(0, 0, 0, 85, 100), (1, 0, 0, 100, 80)],
        "equal": [(0, 0, 0, 10, 10), (1, 0, 0, 10, 10)],
        "flat": [(0, 5, 5, 5, 9)],
    }
    rng = np.random.default_rng(1)
    for k in range(20):
        pages_of[f"r{k}"] = [(i, int(x), int(y), int(x + w), int(y + h)) for i, (x, y, w, h) in enumerate(rng.integers(0, 40, (12, 4)))]
    rows = [(k, *b) for k, bs in pages_of.items() for b in bs]
    df = spark.createDataFrame(rows, "page_key string, idx int, x0 int, y0 int, x1 int, y1 int")
    got: dict[str, set] = {k: set() for k in pages_of}
    for r in boxes.without_swallowed(df).collect():
        got[r.page_key].add(r.idx)
    assert got == {k: brute_survivors(b) for k, b in pages_of.items()}
    assert got["nested"] == {0}


def test_paragraphs():
    two = boxes.paragraphs_of([(0, 0, 100, 10), (0, 14, 100, 24), (300, 0, 400, 10), (300, 14, 400, 24)])
    assert two == [[0, 0, 100, 24], [300, 0, 400, 24]]
    assert len(boxes.paragraphs_of([(0, 0, 100, 10), (0, 15, 100, 25)])) == 1  # gap equal to the limit
    assert len(boxes.paragraphs_of([(0, 0, 100, 10), (0, 15.1, 100, 25.1)])) == 2
    assert len(boxes.paragraphs_of([(0, 0, 100, 10), (0, 9, 100, 19)])) == 2  # overlapping lines are not merged
    assert boxes.paragraphs_of([]) == []


def test_paragraph_rows(spark):
    rows = spark.createDataFrame([("p", 0, 0, 0, 100, 10), ("p", 1, 0, 14, 100, 24), ("q", 0, 1, 1, 2, 2)], "page_key string, idx int, x0 int, y0 int, x1 int, y1 int")
    got = sorted(tuple(r) for r in boxes.paragraphs(rows).collect())
    assert got == [("p", 0, 0.0, 0.0, 100.0, 24.0), ("q", 0, 1.0, 1.0, 2.0, 2.0)]


def test_reading_order_and_ids(spark):
    rows = spark.createDataFrame([("p", 0, 50, 39, "Text"), ("p", 1, 10, 5, "PageHeader"), ("p", 2, 0, 40, "Table"), ("p", 3, 0, -1, "Text")], "page_key string, idx int, x0 int, y0 int, label string")
    made = boxes.region_ids(rows, [*boxes.reading_order(F.struct("y0", "x0")), F.col("idx")], "block_%03d", with_label=False)
    got = {r.idx: r.region_id for r in pages.without_empty_labels(made).collect()}
    assert got == {3: "block_000", 0: "block_002", 2: "block_003"}  # the excluded label leaves a gap
    named = boxes.region_ids(rows, [F.col("y0"), F.col("idx")], "region_%02d_%s")
    assert {r.idx: r.region_id for r in named.collect()}[3] == "region_00_Text"


def test_strips(spark):
    rows = spark.createDataFrame([("a", 800), ("b", 801), ("c", 2000), ("d", 0), ("e", None)], "page_key string, height int")
    got: dict[str, list] = {}
    for r in boxes.strips(rows).orderBy("page_key", "strip_idx").collect():
        got.setdefault(r.page_key, []).append((r.y0, r.y1))
    assert got == {"a": [(0, 800)], "b": [(0, 800), (600, 801)], "c": [(0, 800), (600, 1400), (1200, 2000)]}


def test_first_confident(spark):
    rows = spark.createDataFrame(
        [("a", 0, 90, 4.0), ("a", 3, 180, 4.01), ("a", 2, None, 9.0), ("b", 0, 90, 1.0), ("c", 0, 45, 9.0), ("d", 200, 90, 9.0)], "page_key string, patch int, angle int, confidence double"
    )
    keys = spark.createDataFrame([(k,) for k in "abcde"], "page_key string")
    got = {r.page_key: (r.angle, r.tier) for r in detection.angles(keys, rows).collect()}
    assert got == {"a": (180, "patch"), "b": (0, "none"), "c": (0, "page"), "d": (0, "none"), "e": (0, "none")}
    asked = []

    def fallback(open_):
        asked.append({r.page_key for r in open_.collect()})
        return open_.where("page_key = 'b'").select("page_key", F.lit(270).alias("angle"))

    got = {r.page_key: (r.angle, r.tier) for r in detection.angles(keys, rows, fallback).collect()}
    assert asked == [{"b", "d", "e"}] and got["b"] == (270, "model") and got["d"] == (0, "none")


def test_spread_gate(spark):
    sizes = spark.createDataFrame([("tall", 10, 20), ("square", 10, 10), ("wide", 20, 10), ("odd", 20, 10)], "page_key string, width int, height int")
    asked = []

    def model(rows):
        asked.append({r.page_key for r in rows.collect()})
        return rows.where("page_key = 'wide'").select("page_key", F.lit(True).alias("is_composite"))

    got = {r.page_key: r.is_composite for r in detection.spreads(sizes, model).collect()}
    assert got == {"tall": False, "square": False, "wide": True, "odd": False} and asked == [{"wide", "odd"}]


def test_patches(spark):
    rows = detection.patches(spark.createDataFrame([("p", 101, 50)], "page_key string, width int, height int")).collect()
    assert len(rows) == 101 and (rows[0].x, rows[0].y, rows[0].width, rows[0].height) == (0, 0, 101, 50)
    assert all(0 <= r.x <= 51 and 0 <= r.y <= 25 and (r.width, r.height) == (50, 25) for r in rows[1:])


@given(st.integers(1, 5), st.integers(1, 5))
@settings(max_examples=20, deadline=None)
def test_turns(h, w):
    a = np.arange(h * w * 3, dtype=np.uint8).reshape(h, w, 3)
    assert np.array_equal(images.turned(images.turned(a, 90), 270), a)
    assert np.array_equal(images.turned(images.turned(a, 180), 180), a)
    assert np.array_equal(images.turned(a, 90), a[::-1].transpose(1, 0, 2))
    assert np.array_equal(images.turned(a, 33), a)
    assert np.array_equal(images.pixels(images.packed(a)), a)


def page(width=100, height=40):
    a = np.full((height, width, 3), 255, np.uint8)
    rng = np.random.default_rng(0)
    a[5:35, 5:46] = rng.integers(0, 2, (30, 41, 1)) * 255
    a[5:35, 54:95] = rng.integers(0, 2, (30, 41, 1)) * 255
    return a


def test_gutter_lies_between_the_pages():
    assert 46 <= images.gutter_of(page()) < 54
    assert images.gutter_of(np.full((20, 50, 3), 255, np.uint8)) == 20  # a blank strip is cut at its left edge


def test_image_rows(spark):
    a = page()
    schema = "page_key string, crop_idx int, image struct<height:int,width:int,n_channels:int,mode:int,data:binary>, angle int, is_composite boolean"
    rows = spark.createDataFrame([("p", 0, tuple(images.packed(a).values()), 90, True), ("q", 0, tuple(images.packed(a).values()), 0, False)], schema)
    turned = {r.page_key: (r.image.height, r.image.width, r.rotated) for r in images.oriented(rows).collect()}
    assert turned == {"p": (100, 40, True), "q": (40, 100, False)}
    parts = {(r.page_key, r.crop_idx): r.image for r in images.split(rows).collect()}
    assert set(parts) == {("p", 0), ("p", 1), ("q", 0)}
    whole = np.hstack([images.pixels(parts["p", 0].asDict()), images.pixels(parts["p", 1].asDict())])
    assert np.array_equal(whole, a)  # the halves tile the image
    regions = rows.where("page_key = 'q'").select("page_key", F.lit("r").alias("region_id"), F.expr("named_struct('x0', -2, 'y0', 1, 'x1', 9, 'y1', 4)").alias("bbox"), "image")
    got = images.cut_out(regions).first().image
    assert (got.height, got.width) == (3, 9)


@pytest.mark.parametrize(("name", "stem", "ext", "family"), [("a.b.PDF", "a.b", ".pdf", "pdf"), ("x.jpeg", "x", ".jpeg", "image"), ("n.md", "n", ".md", "text"), (".hidden", ".hidden", "", None), ("none", "none", "", None), ("v.xyz", "v", ".xyz", None)])
def test_routing(spark, name, stem, ext, family):
    c = F.col("n")
    row = spark.createDataFrame([(name,)], "n string").select(pages.file_stem(c).alias("s"), pages.extension(c).alias("e"), pages.family(pages.extension(c)).alias("f")).first()
    assert tuple(row) == (stem, ext, family)


def test_keys(spark):
    rows = spark.createDataFrame([("a_page_b", 9), ("s", 99), ("s", 100)], "stem string, page int")
    keys = [r.k for r in rows.select(pages.page_key(F.col("stem"), F.col("page")).alias("k")).collect()]
    assert keys == ["a_page_b_page_09", "s_page_99", "s_page_100"]
    stems = spark.createDataFrame([(k,) for k in [*keys, "plain"]], "k string").select(pages.doc_stem(F.col("k")).alias("s")).collect()
    assert [r.s for r in stems] == ["a_page_b", "s", "s", "plain"]
    assert pages.page_filter(" 1, 3 ") == [1, 3] and pages.page_filter(None) is None and pages.page_filter("") is None
    with pytest.raises(ValueError):
        pages.page_filter("1,x")


def test_last_written(spark):
    rows = spark.createDataFrame([("p", 1, "old", 7), ("p", 2, "new", 7), ("p", 2, "new", 7), ("q", None, "only", 7), (None, 5, "x", 7), ("r", 3, "a", 7), ("r", 3, "b", 7)], "page_key string, written_at int, text string, stem int")
    got = {r.page_key: r.text for r in pages.last_written(rows, fields=("text",)).collect()}
    assert got == {"p": "new", "q": "only", "r": "b"}
