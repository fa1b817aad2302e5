"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from ledgerleaf import registry

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    def value(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return None
        x = x.item() if hasattr(x, "item") else x
        return repr(round(x, 9)) if isinstance(x, float) else str(x)

    data = [tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False)]
    return sorted(data, key=lambda r: [(v is None, v or "") for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    ours = entry_point.queries()[name](spark, DATA).toPandas()
    theirs = duck.sql(entry_point.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry_point.queries()) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns == ["host", "records"] and out.count() > 0
