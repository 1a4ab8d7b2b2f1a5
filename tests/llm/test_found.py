"""The found queries on the smallest test tables: columns as fixed, no repeated rows, and sense."""

from __future__ import annotations

import pytest

from pagewright.llm import sql
from pagewright.llm.queries import QUERIES

COLUMNS = {
    "p1_found": [("page_key", "string")],
    "p2_found": [("page_key", "string"), ("field", "string"), ("kind", "string"), ("val", "string")],
    "p3_found": [("page_key", "string")],
    "p4_found": [("page_key", "string"), ("line_no", "bigint")],
    "p5_found": [("page_key", "string"), ("fault", "string"), ("line_no", "bigint"), ("word", "string")],
    "p6_found": [("stem", "string"), ("name_a", "string"), ("name_b", "string")],
    "p7_found": [("page_key", "string"), ("field", "string"), ("markup", "string")],
    "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p9_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p10_found": [("doc_id_a", "bigint"), ("doc_id_b", "bigint")],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, data, name):
    frame = QUERIES[name](spark, data)
    assert frame.dtypes == COLUMNS[name]
    rows = [tuple(map(str, r)) for r in frame.collect()]
    assert rows and len(rows) == len(set(rows))
    if name == "p2_found":
        assert {r[2] for r in rows} <= {"email", "phone", "id_number", "address", "name"}
        assert all(r[3] == "".join(c for c in r[3].lower() if c.isalnum()) for r in rows)
    if name == "p6_found":
        assert all(r[1] < r[2] for r in rows)
    if name == "p7_found":
        assert {r[2] for r in rows} <= {"html", "markdown", "wiki", "latex"}


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_rows_are_those_of_the_sql(spark, data, name):
    import glob
    import os

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, data)
    want = con.sql(f"SELECT {', '.join(frame.columns)} FROM ({sql.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(want, key=repr) != []


def test_share_against_sql(spark, data):
    import glob
    import os

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = set(con.sql(sql.ORACLE["p3_found"]).df().page_key)
    assert {r.page_key for r in QUERIES["p3_found"](spark, data).collect()} == want


def test_cleaned_pages_have_nothing_left(spark, data):
    from pagewright.llm import markup

    pages = QUERIES["p7_clean"](spark, data).where("text is not null").collect()
    left = [r for r in pages if markup.SUSPECTED.search(r.text) and set(markup.kinds_of(r.text, markup.DEFAULT)) - {"markdown", "latex"}]
    assert len(left) <= len(pages) // 50  # Markdown and formulas are the form that cleaning keeps
