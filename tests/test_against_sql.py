"""Every query with an oracle gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if pd.isna(value):
        return None
    if isinstance(value, pd.Timestamp):
        return str(value)
    if isinstance(value, str):
        return value
    return float(value)


def _table(frame):
    columns = sorted(frame.columns)
    table = [tuple(map(_value, row)) for row in frame[columns].astype(object).itertuples(index=False)]
    return columns, sorted(table, key=repr)


def test_names_are_the_same():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours = _table(contract.queries()[name](spark, SMALL).toPandas())
    theirs = _table(duck.execute(contract.oracle_sql()[name]).fetchdf())
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).count() > 0
