"""Every registered key against its DuckDB statement on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["documents", "pages", "conversations", "benchmark"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.12g}"
    return "∅" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_key_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(res.columns, res.fetchall())


def test_every_key_has_oracle():
    from ferret.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "line_no", "line", "matched_token", "select_score", "confidence"]
    assert df.count() >= 0
