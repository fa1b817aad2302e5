"""Data-quality checks over any table with an id, a URL and a JSON column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerleaf.functions import json as J
from ledgerleaf.operators.dedup import duplicate_keys


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def count_by_json_int(df: DataFrame, column: str, path: str, name: str = "page",
                      strict: bool = False) -> DataFrame:
    """Rows per integer at a JSON path, rows without the key left out.

    Text that is no integer fails the job under ``strict``; otherwise those rows form the
    NULL group, so nothing disappears from the counts.
    """
    texts = df.select(J.json_text(column, path).alias("_text")).where(F.col("_text").isNotNull())
    counts = texts.groupBy(J.text_int("_text", strict).alias(name)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.asc_nulls_last(name))


def bad_json_ints(df: DataFrame, column: str, path: str) -> DataFrame:
    return df.agg(F.count_if(J.bad_int(column, path)).alias("bad_values"))


def latest(df: DataFrame, column: str, paths: dict[str, str], take: list[str] | None = None,
           n: int = 5, by: str = "id") -> DataFrame:
    """The newest rows by id with texts picked out of their JSON column."""
    picked = [J.json_text(column, p).alias(name) for name, p in paths.items()]
    newest = df.orderBy(F.desc_nulls_first(by)).limit(n)
    return newest.select(by, *(take or []), *picked)


def quality_report(df: DataFrame, column: str = "metadata", page_path: str = "$.page_number",
                   city_path: str = "$.address.city") -> dict[str, DataFrame]:
    """The four checks of a listing table: total, per page, repeated URLs, newest rows."""
    return {
        "total": row_count(df),
        "per_page": count_by_json_int(df, column, page_path),
        "duplicates": duplicate_keys(df, "url"),
        "latest": latest(df, column, {"page": page_path, "city": city_path}, ["title"]),
    }
