"""Every query runs, and gives what its SQL gives, on the smallest test tables."""

from __future__ import annotations

import glob
import math
import os

import pytest

from pagewright.catalog import ORACLE, QUERIES


def rows_of(frame) -> list:
    def plain(v):
        if v is None or type(v).__name__ in ("NAType", "NaTType"):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    columns = sorted(frame.columns)
    return sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in ORACLE:
        want = duck.sql(ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert entry.queries()["scorecard"](spark, data).count() == 1
