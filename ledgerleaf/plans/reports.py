"""Operational reports.  Each takes table frames and returns a lazy frame.

Null order is spelled out everywhere (descending: NULLs first, ascending: NULLs last),
and every limit has the id as tie-breaker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerleaf.operators.joins import per_key, with_matching_ids


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL text with bound ``:name`` parameters."""
    return spark.sql(text, args=params)


def _only(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def overview(sources: DataFrame, raw: DataFrame, masters: DataFrame) -> DataFrame:
    """One row with the three table counts."""
    return sources.sparkSession.sql(
        """SELECT (SELECT count(*) FROM {sources}) AS sources_count,
                  (SELECT count(*) FROM {raw}) AS raw_count,
                  (SELECT count(*) FROM {masters}) AS master_count""",
        sources=sources, raw=raw, masters=masters,
    )


def source_names(sources: DataFrame) -> DataFrame:
    return sources.select("name")


def find(df: DataFrame, **values) -> DataFrame:
    """At most one row whose columns have the given values."""
    for name, value in values.items():
        df = df.where(F.col(name) == value)
    return df.limit(1)


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def recent_runs(runs: DataFrame, sources: DataFrame, n: int = 10) -> DataFrame:
    """The latest runs with their source's name; runs without a known source drop out."""
    named = runs.join(sources.select(F.col("id").alias("_sid"), F.col("name").alias("source")),
                      F.col("source_id") == F.col("_sid"))
    shown = _only(named, ["id", "source", "start_time", "end_time", "status", "items_processed"])
    return named.orderBy(F.desc_nulls_first("start_time"), F.desc("id")).limit(n).select(*shown)


def source_stats(sources: DataFrame, raw: DataFrame) -> DataFrame:
    """Records and first/last time per source name; sources without records count 0."""
    counted = per_key(raw, "source_id", _n=F.count("id"), _lo=F.min("scraped_at"), _hi=F.max("scraped_at"))
    joined = sources.select("id", "name").join(counted, F.col("id") == F.col("source_id"), "left")
    return joined.groupBy(F.col("name").alias("source")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records"),
        F.min("_lo").alias("first_scrape"),
        F.max("_hi").alias("last_scrape"),
    )


def source_counts(sources: DataFrame, raw: DataFrame) -> DataFrame:
    counted = per_key(raw, "source_id", _n=F.count("id"))
    joined = sources.select("id", "name").join(counted, F.col("id") == F.col("source_id"), "left")
    return joined.groupBy(F.col("name").alias("source")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("count")
    )


def _by_source_name(df: DataFrame, sources: DataFrame, name: str) -> DataFrame:
    return with_matching_ids(df, "source_id", sources.where(F.col("name") == name).select("id"))


def raw_explorer(raw: DataFrame, sources: DataFrame, source: str, status: str = "All") -> DataFrame:
    """Raw rows of one source, optionally of one processing status."""
    rows = _by_source_name(raw, sources, source)
    if status != "All":
        rows = rows.where(F.col("processing_status") == status)
    return rows.select(*_only(raw, ["id", "url", "scraped_at", "processing_status", "raw_content"]))


def cleaned_explorer(cleaned: DataFrame, sources: DataFrame, source: str, status: str = "All") -> DataFrame:
    rows = _by_source_name(cleaned, sources, source)
    if status != "All":
        rows = rows.where(F.col("validation_status") == status)
    return rows.select(*_only(
        cleaned, ["id", "name", "category", "address", "contact", "cleaned_at", "validation_status"]
    ))


def search(masters: DataFrame, term: str, n: int = 100) -> DataFrame:
    """Masters whose name or external id contains ``term``, ignoring case.

    ``%``, ``_`` and a backslash in the term act as pattern characters.  An empty term
    gives the latest records instead.
    """
    if not term:
        return recent_records(masters, n)
    pattern = f"%{term}%"
    return masters.where(F.col("name").ilike(pattern) | F.col("external_id").ilike(pattern))


def recent_records(masters: DataFrame, n: int = 100) -> DataFrame:
    return masters.orderBy(F.desc_nulls_first("updated_at"), F.desc("id")).limit(n)


def records_per_day(raw: DataFrame) -> DataFrame:
    days = raw.groupBy(F.to_date("scraped_at").alias("date")).agg(F.count("*").alias("count"))
    return days.orderBy(F.asc_nulls_last("date"))


def status_distribution(cleaned: DataFrame, status: str = "validation_status") -> DataFrame:
    """Rows per status; NULL is a group of its own."""
    return cleaned.groupBy(status).agg(F.count("*").alias("count"))


def status_share(cleaned: DataFrame, status: str = "validation_status") -> DataFrame:
    """`status_distribution` with each status's share of all rows."""
    counts = status_distribution(cleaned, status)
    total = F.sum("count").over(Window.partitionBy())  # over one row per status
    return counts.withColumn("share", F.col("count") / total.cast("double"))
