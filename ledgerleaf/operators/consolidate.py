"""Master records: merge by key, resolve conflicts, keep lineage.

Every step is one aggregate on the key with map-side partials, so a key that holds a
large share of all records costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf.functions import text as X

from .joins import join_reduced


def merge(df: DataFrame, key: str, record_id: str, source: str) -> DataFrame:
    """Per non-NULL key: first and last record id, records and distinct sources."""
    per_pair = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, source)
        .agg(F.min(record_id).alias("_lo"), F.max(record_id).alias("_hi"), F.count("*").alias("_n"))
    )
    return per_pair.groupBy(key).agg(
        F.min("_lo").alias("first_id"),
        F.max("_hi").alias("last_id"),
        F.sum("_n").alias("records"),
        F.count(F.col(source)).alias("sources"),
    )


def resolve(df: DataFrame, key: str, better: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """The best row per key: ``better`` sorts ascending, best first, and ends in a unique id."""
    best = F.min_by(F.struct(*take), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(better)]))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def lineage(df: DataFrame, key: str, source: str) -> DataFrame:
    """Sorted distinct sources per key.  The list is as long as there are sources."""
    pairs = df.where(F.col(key).isNotNull() & F.col(source).isNotNull()).select(key, source).distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def master_records(cleaned: DataFrame, confidence: DataFrame | None = None) -> DataFrame:
    """Master rows (without ids) from cleaned records.

    Records share a master row when their cleaned, lower-cased name and city agree; blank
    names are left out.  Each field takes its first non-blank value by confidence, then by
    latest cleaning, then by id.  ``confidence`` is (cleaned_data_id, confidence_score) and
    may list a record several times; the highest counts.
    """
    key = X.match_key("name", "address.city")
    rows = cleaned.withColumn("_key", key).where(F.col("_key").isNotNull())
    if confidence is None:
        rows = rows.withColumn("_conf", F.lit(None).cast("double"))
    else:
        best = confidence.groupBy(F.col("cleaned_data_id").alias("id")).agg(
            F.max("confidence_score").alias("_conf")
        )
        rows = rows.join(best, "id", "left")
    # Largest wins: NULL confidence sorts lowest, later cleaning higher, smaller id higher.
    rank = F.struct("_conf", "cleaned_at", (-F.col("id")).alias("_id"))

    def field(path: str, name: str) -> Column:
        return F.max_by(F.col(path), F.when(~X.is_blank(path), rank)).alias(name)

    merged = rows.groupBy("_key").agg(
        field("name", "name"),
        field("category", "type"),
        field("address.street", "street"),
        field("address.city", "city"),
        field("contact.phone", "phone"),
        field("contact.hours", "hours"),
        F.max_by(F.struct("id", "raw_data_id", "source_id"), rank).alias("_best"),
        F.count("*").alias("record_count"),
        F.array_sort(F.collect_set("source_id")).alias("sources"),
        F.min("cleaned_at").alias("created_at"),
        F.max("cleaned_at").alias("updated_at"),
        F.max("_conf").alias("confidence_score"),
    )
    return merged.select(
        F.md5("_key").alias("external_id"),
        "name",
        "type",
        F.lit("active").alias("status"),
        F.to_json("_best", {"ignoreNullFields": "false"}).alias("primary_data"),
        F.struct("street", "city").alias("address"),
        F.struct("phone", "hours").alias("contact"),
        F.to_json(F.struct("record_count")).alias("data_json"),
        "sources",
        "created_at",
        "updated_at",
        "confidence_score",
    )


def retry_list(failures: DataFrame, successes: DataFrame, key: str, at: str) -> DataFrame:
    """Failures with no later success of the same key; successes shrink to one row per key."""
    last = successes.groupBy(key).agg(F.max(at).alias("_last"))
    return join_reduced(failures, last, key, "left_anti", F.col("_last") > F.col(at))
