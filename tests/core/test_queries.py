"""Every registered query with SQL against DuckDB at sf0.001."""

import math
import os
from glob import glob

import duckdb
import pandas as pd
import pytest

from sparkwharf.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


def plain(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, bool) or not isinstance(v, (int, float)) and not hasattr(v, "dtype"):
            return str(v)
        return f"{float(v):.9g}" if str(v) not in ("True", "False") else str(v)

    return sorted(tuple(cell(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, con, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), con.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
