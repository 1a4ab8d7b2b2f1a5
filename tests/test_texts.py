from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.config import SAFE_WORDS, TASKS, PipelineConfig
from pagewright.operators import chunking, documents, redaction


# ---- chunking


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []),
        ("x" * 1500, [(0, 1500)]),
        ("x" * 1000 + " " + "y" * 500, [(0, 1000), (1000, 1501)]),
        ("x" * 1501, [(0, 1500), (1500, 1501)]),
        ("ab " + "z" * 3000, [(0, 2), (2, 1502), (1502, 3002), (3002, 3003)]),  # one long token must not stop the walk
        ("a  b", [(0, 4)]),
    ],
)
def test_blank_spans(text, want):
    assert chunking.blank_spans(text, 1500) == want


@given(st.text(alphabet="ab ,.\n🙂", max_size=120), st.integers(3, 20))
@settings(max_examples=200, deadline=None)
def test_blank_spans_tile_the_text(text, size):
    spans = chunking.blank_spans(text, size)
    assert "".join(text[a:b] for a, b in spans) == text
    assert all(0 < b - a <= size for a, b in spans)


@given(st.text(alphabet="ab ,.\n🙂", max_size=160), st.integers(8, 30), st.integers(0, 6))
@settings(max_examples=200, deadline=None)
def test_overlapping_spans_cover_and_advance(text, size, overlap):
    spans = chunking.overlapping_spans(text, size, overlap)
    covered = set().union(*(range(a, b) for a, b in spans)) if spans else set()
    assert covered == set(range(len(text)))
    assert all(a2 > a1 for (a1, _), (a2, _) in zip(spans, spans[1:]))
    assert all(b - a <= size + 1 for a, b in spans)


def test_overlapping_spans_cases():
    assert chunking.overlapping_spans("", 1500, 150) == []
    for n in (1351, 1400, 1500):
        assert chunking.overlapping_spans("x" * n, 1500, 150) == [(0, n)]
    assert chunking.overlapping_spans("x" * 1400, 1500, 150, tail=True) == [(0, 1400), (1350, 1400)]
    text = "x" * 100 + " " + "y" * 3000
    assert chunking.overlapping_spans(text, 1500, 150)[0] == (0, 1500)  # a cut within the overlap is made hard


def test_native_fold_equals_function(spark):
    texts = ["", "x" * 1500, "x" * 1000 + " " + "y" * 900, "ab " + "z" * 3000, "a 🙂 " * 700, "word " * 1000, " " * 1600]
    rows = spark.createDataFrame(list(enumerate(texts)), "page_key int, text string")
    got = {r.page_key: [tuple(s) for s in r.s] for r in rows.select("page_key", chunking.blank_spans_native(F.col("text")).alias("s")).collect()}
    assert got == {k: chunking.blank_spans(t, 1500) for k, t in enumerate(texts)}


def test_chunks_and_questions(spark):
    rows = spark.createDataFrame([("p", " a b "), ("q", None), ("r", "")], "page_key string, text string")
    made = chunking.chunks(rows, chunking.stage2_spans()(F.col("text")))
    assert [tuple(r) for r in made.collect()] == [("p", 0, 0, 5, "a b")]
    asked = chunking.with_tasks(made, TASKS)
    assert {r.task for r in asked.collect()} == {t for t, _ in TASKS} and asked.count() == 3


# ---- redaction


def spliced(spark, text, entities):
    rows = spark.createDataFrame([(text, entities)], "text string, e array<struct<label:string,start:int,end:int>>")
    return tuple(rows.select(redaction.spliced(F.col("text"), redaction.removable(F.col("e"))).alias("s")).select("s.*").first())


def test_splice(spark):
    assert spliced(spark, "abc", []) == ("abc", [])
    assert spliced(spark, "John met Ann", [("NAME", 0, 4), ("NAME", 9, 12)]) == ("*** met ***", ["Ann", "John"])
    assert spliced(spark, "ab", [("X", 0, 1), ("X", 1, 2)]) == ("******", ["b", "a"])
    assert spliced(spark, "on 1/2/20 Al", [("DATE", 3, 9), ("NAME", 10, 12)]) == ("on 1/2/20 ***", ["Al"])
    assert spliced(spark, "🙂 Al 🙂", [("NAME", 2, 4)]) == ("🙂 *** 🙂", ["Al"])
    assert spliced(spark, "x *** y", [("N", 6, 7)]) == ("x *** ***", ["y"])


def test_labels(spark):
    rows = spark.createDataFrame([((None, "B"),), ((None, None),), (("A", "B"),)], "e struct<entity_group:string,entity:string>")
    assert [r[0] for r in rows.select(redaction.label_of(F.col("e"))).collect()] == ["B", "", "A"]


def replaced(spark, text, words):
    rows = spark.createDataFrame([(text, words)], "t string, w array<string>")
    return tuple(rows.select(redaction.words_replaced(F.col("t"), F.col("w")).alias("s")).select("s.*").first())


@pytest.mark.parametrize(
    ("text", "words", "want"),
    [
        ("Mr O'Brien and Brien", ["O'Brien", "Brien"], ("Mr *** and ***", ["O'Brien", "Brien"])),
        ("x Street, y", ["Street,"], ("x Street, y", [])),
        ("SMITH smith Smithy", ["Smith"], ("*** *** Smithy", ["Smith"])),
        ("éab ab", ["ab"], ("éab ***", ["ab"])),
        ("a+b (a+b)", ["a+b"], ("*** (***)", ["a+b"])),
        (r"has \E inside", [r"\E"], (r"has \E inside", [])),
        ("already ***", ["nope"], ("already ***", [])),
    ],
)
def test_words_replaced(spark, text, words, want):
    assert replaced(spark, text, words) == want


def test_identifier_words_order(spark):
    rows = spark.createDataFrame([(["Al Brien O'Brien 943", "the Dr Brien", None],)], "i array<string>")
    assert rows.select(redaction.identifier_words(F.col("i"), SAFE_WORDS)).first()[0] == ["O'Brien", "Brien"]


def test_words_replaced_like_brute_force(spark):
    texts = ["John Smith of High Street", "smith, SMITH; Smithson", "no names", ""]
    words = ["Smith", "High", "John"]
    rows = spark.createDataFrame([(t, words) for t in texts], "t string, w array<string>")
    got = [r.s.text for r in rows.select(redaction.words_replaced(F.col("t"), F.col("w")).alias("s")).collect()]
    for text, have in zip(texts, got):
        for w in words:
            text = re.sub(rf"(?i)(?<!\w){w}(?!\w)", "***", text)
        assert have == text


def test_audit_records(spark):
    rows = spark.createDataFrame(
        [("a", "Mail jo@x.test on 01/02/2020, Smith", ["Ann Smith"]), ("b", " \n", ["Smith"]), ("c", None, None), ("d", "plain", None)], "page_key string, text string, identifiers array<string>"
    )
    got = {r.page_key: r for r in redaction.audit_records(rows, PipelineConfig()).collect()}
    assert got["a"].roberta_only == "Mail *** on 01/02/2020, Smith"
    assert got["a"].final_llm_scrubbed == "Mail *** on 01/02/2020, ***"
    assert got["a"].redacted_entities == ["Smith", "jo@x.test"]
    for k in "bc":
        assert tuple(got[k])[1:] == ("", "", "", [])
    assert got["d"].final_llm_scrubbed == "plain" and got["d"].redacted_entities == []


def test_redaction_is_idempotent(spark):
    rows = spark.createDataFrame([("a", "Ann Smith, AB12 3CD, ann@x.test", ["Smith"])], "page_key string, text string, identifiers array<string>")
    once = redaction.audit_records(rows).select("page_key", F.col("final_llm_scrubbed").alias("text"), F.array(F.lit("Smith")).alias("identifiers"))
    again = redaction.audit_records(once).first()
    assert again.final_llm_scrubbed == once.first().text and again.redacted_entities == []


# ---- documents


def test_merge_order(spark):
    rows = spark.createDataFrame([("d_page_100", "c"), ("d_page_02", "a"), ("d_page_10", None), ("a_page_b_page_01", "x"), (None, "lost")], "page_key string, text string")
    got = {r.stem: (r.n_pages, r.document) for r in documents.merged_documents(rows).collect()}
    assert set(got) == {"d", "a_page_b"} and got["d"][0] == 3
    order = re.findall(r"## (\S+)", got["d"][1])
    assert order == ["d_page_02", "d_page_10", "d_page_100"]
    assert got["a_page_b"][1] == "# Document: a_page_b\n\n## a_page_b_page_01\n\nx\n\n" + "=" * 50 + "\n\n"
    lexicographic = {r.stem: r.document for r in documents.merged_documents(rows, lexicographic=True).collect()}
    assert re.findall(r"## (\S+)", lexicographic["d"]) == ["d_page_02", "d_page_10", "d_page_100"]


def test_page_texts(spark):
    rows = spark.createDataFrame([("p", 1, "two"), ("p", 0, " one"), ("q", 0, "")], "page_key string, crop_idx int, text string")
    assert {r.page_key: r.text for r in documents.page_texts(rows).collect()} == {"p": "one\n\ntwo", "q": ""}
    assert {r.page_key: r.text for r in documents.page_texts(rows, strip_ends=False).collect()} == {"p": " one\n\ntwo", "q": ""}


def test_trees_and_blocks(spark):
    schema = "pages array<struct<blocks:array<struct<lines:array<struct<words:array<struct<value:string>>>>>>>>, b array<struct<content:string,text:string>>"
    tree = [([([([("a",), ("b",)],), ([("c",)],)],)],)]
    row = spark.createDataFrame([(tree, [(" x ", None), (None, "y"), ("", "z"), (None, None)])], schema).select(documents.tree_text(F.col("pages")), documents.block_text(F.col("b"))).first()
    assert tuple(row) == ("a b\nc", "x\n\ny")


@pytest.mark.parametrize(
    ("markdown", "want"),
    [
        ("# Head\n\ntext **bold** end", "Head text bold end"),
        ("| a | b |\n|---|---|\n| 1 | 2 |", "a b 1 2"),
        ("<p>A &amp; B</p><script>x()</script><!-- c -->", "A & B"),
        ("- one\n- [two](http://x)", "one two"),
        ("", ""),
        (None, None),
    ],
)
def test_plain_text(markdown, want):
    assert documents.plain_text(markdown) == want
