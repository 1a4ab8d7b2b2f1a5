from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagewright.operators import scoring


def test_ground_truth_shapes(spark):
    cases = {
        '{"ID": ["a", "b"]}': ["a", "b"],
        '{"ID": "one"}': ["one"],
        '{"ID": 7}': ["7"],
        '{"name": "x", "n": 3, "town": "y"}': ["x", "y"],
        '[{"ID": "a"}, {"ID": 5}, {"other": 1}]': ["a", "5"],
        "no json": None,
        "3": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", scoring.ground_truth_terms(F.col("raw")).alias("t"))
    got = {r.raw: sorted(r.t) if r.t is not None else None for r in rows.collect()}
    assert got == {k: sorted(v) if v else v for k, v in cases.items()}


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [("p", "Ann Smith saw Bob at noon", "*** *** saw Bob at ***"), ("q", "nobody here", "nobody here"), ("r", None, None), ("z", "unscored Ann", "unscored Ann")],
        "page_key string, clean_ocr string, final_llm_scrubbed string",
    )


@pytest.fixture
def terms(spark):
    return spark.createDataFrame([("p", "Ann Smith"), ("p", "bob"), ("p", "absent"), ("p", ""), ("p", None), ("p", "Bob"), ("q", "x1"), ("r", "y"), ("gone", "t")], "page_key string, term string")


def test_scores(pages, terms):
    targets = scoring.exact_targets(pages, terms)
    assert {(r.page_key, r.target) for r in targets.collect()} == {("p", "ann smith"), ("p", "bob")}
    got = {r.page_key: tuple(r)[1:] for r in scoring.scores(pages, terms, targets).collect()}
    # p: ann smith gone, bob stays; noon went though nobody asked; saw and at are true negatives
    assert got == {"p": (1, 1, 1, 2), "q": (0, 0, 0, 2), "r": (0, 0, 0, 0)}
    card = scoring.scorecard(scoring.scores(pages, terms, targets)).first()
    assert (card.tp, card.fn, card.fp, card.tn) == (1, 1, 1, 4) and card.sensitivity == 50.0 and card.specificity == 80.0


def test_zero_denominators(spark):
    none = spark.createDataFrame([], "page_key string, tp long, fn long, fp long, tn long")
    assert tuple(scoring.scorecard(none).first()) == (0, 0, 0, 0, 0.0, 0.0)


def test_leaks(pages, terms):
    got = [tuple(r) for r in scoring.leaks(scoring.exact_targets(pages, terms)).collect()]
    assert got == [("p", "bob", "...*** *** saw bob at ***...")]


def test_fuzzy_targets(spark):
    pages = spark.createDataFrame([("p", "Jon Smithh lives at 12 High Streat", "*** lives")], "page_key string, clean_ocr string, final_llm_scrubbed string")
    terms = spark.createDataFrame([("p", "Smith"), ("p", "high street")], "page_key string, term string")
    got = {r.target for r in scoring.fuzzy_targets(pages, terms).collect()}
    assert got == {"smith", "smithh", "high streat"}
