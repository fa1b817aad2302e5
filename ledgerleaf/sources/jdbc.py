"""Relational tables over JDBC.  Connection values come from the caller only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Environment variables that describe a connection.
ENV = ("DB_HOST", "DB_PORT", "DB_NAME", "DB_USER", "DB_PASSWORD")


def options_from_env(env: Mapping[str, str]) -> dict[str, str]:
    """Reader/writer options; only the port has a default, a missing value is an error."""
    missing = [k for k in ENV if k != "DB_PORT" and not env.get(k)]
    if missing:
        raise KeyError(f"not set: {', '.join(missing)}")
    port = env.get("DB_PORT") or "5432"
    return {
        "url": f"jdbc:postgresql://{env['DB_HOST']}:{port}/{env['DB_NAME']}",
        "user": env["DB_USER"],
        "password": env["DB_PASSWORD"],
        "driver": "org.postgresql.Driver",
    }


def scan_options(table: str, key: str, low: int, high: int, partitions: int,
                 fetch: int = 10_000) -> dict[str, str]:
    """Split a table scan into ranges of an integer key; rows outside low..high are still read."""
    return {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch),
    }


def read_table(spark: SparkSession, connection: Mapping[str, str], scan: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**connection).options(**scan).load()


def read_query(spark: SparkSession, connection: Mapping[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connection).option("query", query).load()


def append_table(df: DataFrame, connection: Mapping[str, str], table: str, batch: int = 10_000) -> None:
    df.write.format("jdbc").mode("append").options(**connection).options(
        dbtable=table, batchsize=str(batch)
    ).save()
