"""Every registered query against its DuckDB oracle (the driver's check):
same column names, same row count, same multiset of rows."""

import importlib.util
import math
import os

import duckdb
import pytest

from mailstream.plans.oracle import oracle_sql
from mailstream.plans.queries import queries
from mailstream.sources.tables import TABLES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.columns == ["topic", "key", "value", "reason"]
    assert df.count() > 0
    # the optional subpackage also has queries that SQL cannot express
    assert set(queries()) <= set(mod.oracle_sql()) <= set(mod.queries())
