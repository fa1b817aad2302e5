"""Listing pages from tables, from raw files, and from left-over crawl state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerleaf import schemas
from ledgerleaf.functions.text import to_int


def page_table(spark: SparkSession, path: str, schema: T.StructType = schemas.PAGES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def page_files(spark: SparkSession, path: str, source_id: int | None = None,
               run_id: int | None = None, page_pattern: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """One row per file under ``path``; the page number is read from the file name.

    The start page has no number in its name: it is page 1.
    """
    files = spark.read.text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    return files.select(
        F.lit(source_id).cast("bigint").alias("source_id"),
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.coalesce(to_int(F.regexp_extract(name, page_pattern, 1)), F.lit(1)).alias("page_number"),
        name.alias("url"),
        F.col("value").alias("html"),
    )


#: Fixed value: the line format of a failed-page list.
FAILED_LINE = r"^Page (\d+): (\S+)\s*$"


def parse_failed(lines: DataFrame, column: str = "value") -> DataFrame:
    """(page, url, mismatch) from ``Page N: <url>`` lines, repeats removed.

    ``mismatch`` marks lines whose number differs from the one their URL ends in;
    a URL without a number never mismatches.
    """
    line = F.col(column)
    page = to_int(F.regexp_extract(line, FAILED_LINE, 1))
    url = F.regexp_extract(line, FAILED_LINE, 2)
    parsed = lines.where(line.rlike(FAILED_LINE)).select(page.alias("page"), url.alias("url"))
    in_url = to_int(F.regexp_extract("url", r"Seite-(\d+)(?:\.html)?$", 1))
    return parsed.distinct().withColumn("mismatch", F.coalesce(in_url != F.col("page"), F.lit(False)))


def failed_urls(spark: SparkSession, path: str) -> DataFrame:
    return parse_failed(spark.read.text(path))


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The resume point(s): ``{"last_page": n}``."""
    return spark.read.schema("last_page INT").json(path)


def resume_after(pages: DataFrame, state: DataFrame, page: str = "page_number") -> DataFrame:
    """Pages after the highest recorded page; all of them when nothing is recorded."""
    last = state.agg(F.coalesce(F.max("last_page"), F.lit(0))).scalar()
    return pages.where(F.col(page) > last)
