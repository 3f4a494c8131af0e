"""Every query with an oracle must match DuckDB on the smallest tables (the driver repeats this at sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from lodestar.session import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item") and getattr(v, "ndim", 1) == 0:
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6) + 0.0
        return int(v) if v.is_integer() and abs(v) < 2 ** 53 else v
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_callable():
    qs = entry.queries()
    assert len(qs) > 100
    assert set(entry.oracle_sql()) <= set(qs)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "ap", "n_pos"]
    assert df.count() >= 0
