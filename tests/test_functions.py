from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagewright.config import SAFE_WORDS
from pagewright.functions import geometry, replies, strings
from pagewright.functions.similarity import ratio, spellings


def one(spark, column, **values):
    """The value of a column over one row of literals."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("  a b\t\n", "a b"), ("", ""), (" \n ", ""), ("\x0b x", "x")])
def test_strip(spark, raw, want):
    assert one(spark, strings.strip(F.col("t")), t=raw) == want


def test_words_and_tokens(spark):
    assert one(spark, strings.split_words(F.col("t")), t="  a  b\nc ") == ["a", "b", "c"]
    assert one(spark, strings.split_words(F.col("t")), t="") == []
    assert one(spark, strings.word_tokens(F.col("t")), t="Béla's x_1, ну-да") == ["Béla", "s", "x_1", "ну", "да"]
    assert one(spark, strings.ngrams(strings.split_words(F.col("t")), 2), t="a b c") == ["a b", "b c"]
    assert one(spark, strings.ngrams(strings.split_words(F.col("t")), 4), t="a b c") == []


@pytest.mark.parametrize(("word", "want"), [("943", False), ("Dr", False), ("May", False), ("***", False), ("Smith", True), ("The", False), ("12a", True)])
def test_identifier_word(spark, word, want):
    assert one(spark, strings.is_identifier_word(F.col("t"), SAFE_WORDS), t=word) is want


def test_labels_and_cells(spark):
    assert one(spark, strings.sanitised_label(F.col("t")), t='a/b:c "d"\n') == "abc_d"
    assert one(spark, strings.sanitised_label(F.col("t")), t="???") == "unnamed_text"
    assert one(spark, strings.sanitised_label(F.col("t")), t=" x") == "_x"
    assert len(one(spark, strings.sanitised_label(F.col("t")), t="y" * 60)) == 40
    assert one(spark, strings.list_cell(F.split("t", ";")), t="a;b") == "a, b"
    assert spark.range(1).select(strings.list_cell(F.array().cast("array<string>"))).first()[0] == "None"
    assert spark.range(1).select(strings.list_cell(F.lit(None).cast("array<string>"))).first()[0] == "None"
    assert one(spark, strings.int_list(F.col("t")), t="1, 3,5") == [1, 3, 5]
    assert one(spark, strings.int_list(F.col("t")), t="1,x") is None
    assert one(spark, strings.control_to_space(F.col("t")), t="a\x01b\x7fc") == "a b c"


def test_context_is_clipped(spark):
    text = "x" * 50 + "KEY" + "\n" + "y" * 50
    assert one(spark, strings.context(F.col("t"), F.lit("KEY")), t=text) == "..." + "x" * 35 + "KEY" + " " + "y" * 34 + "..."
    assert one(spark, strings.context(F.col("t"), F.lit("KEY")), t="KEY") == "...KEY..."


def test_orientation_reading(spark):
    text = "Page 0\nRotate: 270\nOrientation confidence: 4.01\n"
    assert one(spark, strings.orientation_angle(F.col("t")), t=text) == 270
    assert one(spark, strings.orientation_confidence(F.col("t")), t=text) == 4.01
    assert one(spark, strings.orientation_angle(F.col("t")), t="no reading") is None


def test_markup_chain(spark):
    text = "<!-- c --><script>x('</p>')</script>## Head\n<p>A &amp; B</p> **bold** | a |\n|---|:-:|"
    got = one(spark, strings.strip_markup(F.col("t")), t=text)
    assert "x(" not in got and "A & B" in got and "bold" in got and "---" not in got and "<" not in got


FENCE = "```"


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"contains_pii": true, "extracted_identifiers": ["a", "b"]}', ["a", "b"]),
        ('{"contains_pii": false, "extracted_identifiers": ["a"]}', ["a"]),  # the flag's value has no effect
        ('{"contains_pii": "on"}', []),
        ('{"contains_pii": "yes", "extracted_identifiers": []}', []),
        ('{"contains_pii": 1.0, "extracted_identifiers": ["x"]}', ["x"]),
        ('{"contains_pii": 2}', None),
        ('{"contains_pii": null}', None),
        ('{"extracted_identifiers": ["x"]}', None),
        ('{"contains_pii": true, "extracted_identifiers": null}', None),
        ('{"contains_pii": true, "extracted_identifiers": ["x", 3]}', None),
        ('{"contains_pii": true, "extracted_identifiers": ["x"],}', None),
        ('Here:\n' + FENCE + 'json\n{"contains_pii": true, "extracted_identifiers": ["f"]}\n' + FENCE + '\n' + FENCE + 'json\n{}\n' + FENCE, ["f"]),
        ('so {"contains_pii": true, "extracted_identifiers": ["p"], "more": 1} ok', ["p"]),
        ("no braces", None),
        ("} {", None),
        ("", None),
    ],
)
def test_identifier_reply(spark, raw, want):
    assert one(spark, replies.identifiers(F.col("t")), t=raw) == want


@pytest.mark.parametrize(("value", "want"), [("90", 90), ('"90"', 90), ("90.0", 90), ('" 90 "', 90), ("true", 0), ("90.5", 0), ("45", 0), ("null", 0), ('"x"', 0), ("270", 270)])
def test_rotation_reply(spark, value, want):
    assert one(spark, replies.rotation_angle(F.col("t")), t=f'ok {{"thinking": "t", "rotation_angle": {value}}}') == want


def test_rotation_reply_needs_thinking(spark):
    assert one(spark, replies.rotation_angle(F.col("t")), t='{"rotation_angle": 90}') == 0


@pytest.mark.parametrize(("value", "want"), [("true", True), ('"true"', True), ("1", True), ("0", False), ('"<boolean>"', False), ("2", False)])
def test_spread_reply(spark, value, want):
    assert one(spark, replies.is_spread(F.col("t")), t=f'{{"thinking": "t", "is_composite_spread": {value}}}') is want


def test_geometry(spark):
    b = geometry.box(F.lit(2), F.lit(3), F.lit(12), F.lit(13))
    c = geometry.box(F.lit(7), F.lit(3), F.lit(30), F.lit(13))
    row = spark.range(1).select(geometry.area(b), geometry.shared_area(b, c), geometry.covered(b, c), geometry.padded(b, 6, F.lit(15), F.lit(100))).first()
    assert row[0] == 100 and row[1] == 50 and row[2] == 0.5
    assert tuple(row[3]) == (0, 0, 15, 19)
    w, h = geometry.fitted_size(F.lit(2000), F.lit(1000), 896)
    assert tuple(spark.range(1).select(w, h).first()) == (896, 448)
    assert geometry.page_scale(144) == 2.0


@pytest.mark.parametrize(("sums", "want"), [([5] * 10, 4), ([9, 9, 9, 9, 3, 1, 9, 9, 9, 9], 5), ([0, 9, 9, 9, 2, 2, 9, 9, 9, 9], 4)])
def test_gutter(spark, sums, want):
    assert spark.createDataFrame([(sums,)], "s array<int>").select(geometry.gutter(F.col("s"))).first()[0] == want


def test_centre_gutter(spark):
    assert spark.createDataFrame([([0] * 20,)], "s array<int>").select(geometry.gutter(F.col("s"), centre=True)).first()[0] == 10


def test_similarity(spark):
    rows = spark.createDataFrame([("smith", "smyth"), ("a", None)], "a string, b string").select(ratio("a", "b").alias("r")).collect()
    assert rows[0].r == pytest.approx(0.8) and rows[1].r is None
    text = "john smithh lives at high streat now"
    rows = spark.createDataFrame([("smith", text, text.split()), ("high street", text, text.split()), ("absent", text, text.split()), ("", text, text.split()), (None, None, None)], "t string, x string, w array<string>")
    got = [r.s for r in rows.select(spellings()("t", "x", "w").alias("s")).collect()]
    assert got == [["smith", "smithh"], ["high streat"], [], [], []]
