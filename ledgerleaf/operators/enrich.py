"""Look-ups that add data to cleaned records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def look_up(df: DataFrame, reference: DataFrame, key: str, reference_key: str,
            take: Sequence[str]) -> DataFrame:
    """Left join to a reference table; ``confidence_score`` is 1.0 on a match, else NULL."""
    ref = reference.select(
        F.col(reference_key).alias("_key"), *take, F.lit(1.0).alias("confidence_score")
    )
    return df.join(ref, df[key] == F.col("_key"), "left").drop("_key")


def enriched_rows(cleaned: DataFrame, reference: DataFrame, key: Column, reference_key: str,
                  take: Sequence[str], kind: str, source: str, now: Column | None = None) -> DataFrame:
    """Rows of enriched_data (without ids): one per cleaned record and matching reference row."""
    keyed = cleaned.select(F.col("id").alias("cleaned_data_id"), key.alias("_k"))
    hits = keyed.where(F.col("_k").isNotNull()).join(
        reference.select(F.col(reference_key).alias("_k"), *take), "_k"
    )
    return hits.select(
        "cleaned_data_id",
        F.lit(kind).alias("enrichment_type"),
        F.to_json(F.struct(*take), {"ignoreNullFields": "false"}).alias("data"),
        F.lit(source).alias("source"),
        (F.current_timestamp() if now is None else now).alias("enriched_at"),
        F.lit(1.0).alias("confidence_score"),
    )


def cross_reference(df: DataFrame, key: str, source: str, at_least: int = 2) -> DataFrame:
    """Keys that occur in several sources, with record and source counts.

    Records are reduced per (key, source) first, so a hot key or source stays small.
    """
    per_pair = df.where(F.col(key).isNotNull()).groupBy(key, source).agg(F.count("*").alias("_n"))
    per_key = per_pair.groupBy(key).agg(
        F.sum("_n").alias("records"), F.count(F.col(source)).alias("sources")
    )
    return per_key.where(F.col("sources") >= at_least)
