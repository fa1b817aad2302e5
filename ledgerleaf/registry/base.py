"""Registration and table access."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Python's whitespace spelled out for an engine without Unicode classes.
SQL_SPACE = (
    r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]"
)


class Tables:
    """``t.orders`` reads ``<dir>/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(pin_utc(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
