"""Every query against its independent SQL on the small tables."""

import math

import duckdb
import pandas as pd
import pytest

from tallyhouse.catalog import QUERIES
from tallyhouse.oracle import ORACLES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows(frame):
    columns = sorted(frame.columns)
    out = [tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)]
    return columns, sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ours = rows(QUERIES[name](spark, FOLDER).toPandas())
    theirs = rows(duck.execute(ORACLES[name]).df())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
