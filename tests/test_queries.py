"""Every registered core query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tributary import queries as core

SF = "/root/testdata/sf0.001"


def plain(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None).astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    got, wanted = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert plain(got) == plain(wanted)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
