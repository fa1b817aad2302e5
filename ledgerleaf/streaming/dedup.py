"""Duplicate removal inside a stream, without a history table.

State grows with the number of keys; prefer `ledgerleaf.streaming.ingest`, whose history
is a table, and use the watermarked form where repeats only come close together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def unique_by_hash(items: DataFrame, key: str = "hash") -> DataFrame:
    return items.dropDuplicates([key])


def unique_within(items: DataFrame, at: str, horizon: str, key: str = "hash") -> DataFrame:
    """One row per key within ``horizon`` of event time; older keys are forgotten."""
    return items.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])
