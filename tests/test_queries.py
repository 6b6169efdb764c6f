"""Every registered query of the engine against DuckDB on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pytest

from eventloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({ORACLES[name]})").fetchall()
    assert ours == sorted(tuple(map(plain, r)) for r in found)


def test_exact_index(spark, con):
    """The rows at the positions that numpy draws, in order of the file."""
    keys = [k for (k,) in con.execute(f"SELECT o_orderkey FROM read_parquet('{SF}/orders.parquet', file_row_number = true) ORDER BY file_row_number").fetchall()]
    drawn = np.sort(np.random.default_rng(42).choice(len(keys), size=100, replace=False))
    assert [r.o_orderkey for r in QUERIES["sample_exact_index"](spark, SF).collect()] == [keys[g] for g in drawn]
