from __future__ import annotations

import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockloom.session import build_session  # noqa: E402
from stockloom.sources.star_schema import Business  # noqa: E402

DATA = "/root/testdata/sf0.001"
RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="stockloom-test-"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def business(spark):
    return Business(spark, DATA)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con
