"""Every registered query that has SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query(spark, tables, name):
    own = __spark_entry__.queries()[name](spark, SF).toArrow()
    other = tables.sql(__spark_entry__.oracle_sql()[name]).to_arrow_table()
    assert sorted(own.column_names) == sorted(other.column_names)
    columns = ", ".join(f'"{c}"' for c in sorted(own.column_names))
    for a, b in (("own", "other"), ("other", "own")):
        assert tables.sql(f"select {columns} from {a} except all select {columns} from {b}").fetchall()[:2] == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 275
