"""Every query on empty tables, and on tables with nulls, empty, blank, very long and repeated rows, ties and extra columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagewright.llm.queries import QUERIES

from .conftest import SCHEMAS, audit_row

LONG = "The ward round went on. " * 5_000


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    audit = [
        audit_row("s_page_01", None),
        audit_row("s_page_02", ""),
        audit_row("s_page_03", " \n\t"),
        audit_row("s_page_04", LONG, LONG, ["x", None]),
        audit_row("s_page_05", "old", day=0),
        audit_row("s_page_05", "new", day=1),
        audit_row("s_page_05", "new", day=1),
        audit_row("s_page_06", "tie a"),
        audit_row("s_page_06", "tie b"),
        audit_row(None, "no key", "no key", ["y"]),
        audit_row("nostem", "x\ny", "z", []),
        ("s_page_07", "no date", None, None, None, None),
        audit_row("s_page_xx", "[1]\n-\n\\\n$"),
        audit_row("s_page_09", "a" * 200_000),
    ]
    lists = [(1, None, "s_page_04", 0, "t", None, ["Ann Smith", None, ""], None), (2, "s", None, 0, None, True, None, None), (2, "s", None, 0, None, True, None, None), (3, "s", "s_page_04", None, None, False, [], None)]
    corpus = [("s_page_04", None, None, None), (None, "<b>x</b>", None, None), ("s_page_05", "", None, None), ("s_page_06", "<p>" * 3000, None, None), ("s_page_06", "<p>" * 3000, None, None)]
    documents = [(1, None, None, None, None, None, None, None), (2, "", None, None, 0, None, None, None), (3, LONG, None, None, None, None, None, None), (4, "а" * 300 + "​", None, None, None, None, None, None), (5, LONG, None, None, None, None, None, None)]
    items = [(1, None, None, None), (2, None, "", None), (3, None, "one two", None), (4, None, "the ward round went on the ward round", None)]
    given = {"audit_trail": audit, "patient_data_extractor": lists, "corpus_dict": corpus, "documents": documents, "eval_items": items}
    for name, schema in SCHEMAS.items():
        rows = spark.createDataFrame(given.get(name, []), schema)
        # names that the operators use within, as columns of the input
        for extra in ("text", "stem", "word", "kind", "form", "n", "line_no", "_newest", "token"):
            if extra not in rows.columns:
                rows = rows.withColumn(extra, F.lit(1))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_tables(spark, odd, name):
    frame = QUERIES[name](spark, odd)
    rows = frame.collect()
    if name in ("p2_scrubbed", "p4_clean", "p5_repaired", "p7_clean", "p3_quality"):
        assert len(rows) == 10  # one for each page_key
        by = {r.page_key: r for r in rows}
        if name != "p3_quality":
            assert by["s_page_01"].text is None and by["s_page_05"].text == "new" and by["s_page_06"].text == "tie b"
        else:
            assert by["s_page_01"].repeated_share == 0 and by["s_page_04"].repeated_share > 0.9
    if name == "p3_found":
        assert {r.page_key for r in rows} == {"s_page_04"}
    if name == "p8_ids":
        ids = {r.doc_id: r.ids for r in rows}
        assert ids[1] == [] and ids[2] == [] and len(ids) == 5 and ids[3] == ids[5] and len(ids[3]) > 25_000
    if name == "p10_found":
        assert rows == []  # equal texts aren't a case


def test_current_rows(spark, written_tables):
    from pagewright.llm.common import current_rows, table

    folder = written_tables(audit_trail=[audit_row("p", "a", day=1), audit_row("p", "b", day=2), audit_row("p", "b", day=2), audit_row("q", None), audit_row(None, "x")])
    got = {r.page_key: r.clean_ocr for r in current_rows(table(spark, folder, "audit_trail"), "clean_ocr").collect()}
    assert got == {"p": "b", "q": None}
