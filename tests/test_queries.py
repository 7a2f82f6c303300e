"""Every registered query against its SQL on the shared test tables."""

import datetime as dt
import os
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from windrow.plans import oracle
from windrow.plans.queries import QUERIES

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(frame):
    """Rows sorted by all columns, columns sorted by name, one representation per kind of value."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].map(lambda v: isinstance(v, dt.date)).any():
            frame[c] = pd.to_datetime(frame[c])
        if frame[c].dtype.kind == "M":
            frame[c] = frame[c].astype("datetime64[us]")
        elif frame[c].dtype.kind in "iuf":
            frame[c] = frame[c].astype(float)
        else:
            frame[c] = frame[c].map(lambda v: "" if v is None or v is pd.NaT or v != v else str(v))
    return frame.sort_values(list(frame.columns), ignore_index=True)


def test_contract():
    assert QUERIES.keys() == oracle.sql().keys()
    assert QUERIES.items() <= contract.queries().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, str(DATA))
    expected = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    a, b = normal(got.toPandas()), normal(expected)
    assert len(a) == len(b) > 0
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_array_equal(a[c].to_numpy(), b[c].to_numpy(), err_msg=f"{name}.{c}")
        else:
            assert a[c].tolist() == b[c].tolist(), f"{name}.{c}"


def test_flagship(spark):
    result = contract.entry(spark)
    assert result.count() > 0
