"""Sources and ingest runs.

The run ledger is append-only: every open, progress note, error and close is a row, and
`run_state` folds them into one row per run.  Runs are opened and closed by the driver;
what fails on individual pages or items is stored as rows of its own tables.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerleaf import schemas

from .ingest import with_ids
from .joins import fill_defaults

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def new_sources(existing: DataFrame, incoming: DataFrame, now: Column | None = None,
                after: int = 0) -> DataFrame:
    """Rows to append for sources not known by name: one per name, defaults filled in."""
    others = [c for c in incoming.columns if c != "name"]
    first = incoming.groupBy("name").agg(F.min(F.struct(*others)).alias("_s")).select("name", "_s.*")
    fresh = first.join(existing.select("name").distinct(), "name", "left_anti")
    full = fill_defaults(fresh, schemas.DEFAULTS["data_sources"], now,
                         schemas.TIMESTAMP_DEFAULTS["data_sources"])
    return with_ids(full, after)


def get_or_create(existing: DataFrame, incoming: DataFrame, key: str = "name") -> DataFrame:
    """Existing names as ``old`` and the incoming names missing from them as ``new``."""
    old = existing.select(key).distinct()
    new = incoming.select(key).distinct().join(old, key, "left_anti")
    return old.withColumn("state", F.lit("old")).unionByName(new.withColumn("state", F.lit("new")))


def change(spark: SparkSession, run_id: int, seq: int, **values) -> DataFrame:
    """One ledger row; columns not named stay NULL."""
    row = {f.name: values.get(f.name) for f in schemas.RUN_CHANGES.fields}
    row.update(id=run_id, seq=seq)
    return spark.createDataFrame([row], schemas.RUN_CHANGES)


def open_run(spark: SparkSession, run_id: int, source_id: int | None, config: dict | None = None,
             at: datetime | None = None, seq: int = 0) -> DataFrame:
    snapshot = None if config is None else json.dumps(config, sort_keys=True)
    return change(spark, run_id, seq, source_id=source_id, start_time=at or utc_now(),
                  status="running", config_snapshot=snapshot)


def record_error(spark: SparkSession, run_id: int, seq: int, message: str,
                 at: datetime | None = None) -> DataFrame:
    stamp = (at or utc_now()).replace(tzinfo=None).isoformat()
    return change(spark, run_id, seq, error={"timestamp": stamp, "error": message})


def close_run(spark: SparkSession, run_id: int, seq: int, at: datetime | None = None) -> DataFrame:
    return change(spark, run_id, seq, status="completed", end_time=at or utc_now())


def run_counts(items: DataFrame, raw: DataFrame) -> DataFrame:
    """(id, items_seen, items_new) per run; each side is reduced to runs before they meet."""
    seen = items.groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("items_seen"))
    new = (
        raw.where(F.col("error").isNull())
        .groupBy(F.col("run_id").alias("_id"))
        .agg(F.count("*").alias("items_new"))
    )
    joined = seen.join(new, F.col("id").eqNullSafe(F.col("_id")), "left")
    return joined.select("id", "items_seen", F.coalesce("items_new", F.lit(0)).alias("items_new"))


def run_state(changes: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """Current row of every run: latest value per column, all errors, summed counters.

    ``items_processed`` counts every entry seen, duplicates included; ``stats`` also has
    the new ones.
    """
    def latest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)

    noted = F.collect_list(F.when(F.col("error").isNotNull(), F.struct("seq", "error")))
    errors = F.transform(F.array_sort(noted), lambda e: e["error"])
    runs = changes.groupBy("id").agg(
        *[latest(c) for c in ("source_id", "start_time", "end_time", "status", "config_snapshot")],
        F.when(F.size(errors) > 0, errors).alias("errors"),
    )
    none = F.lit(None).cast("bigint")
    if progress is None:
        runs = runs.withColumns({"items_seen": none, "items_new": none})
    else:
        totals = progress.groupBy("id").agg(
            F.sum("items_seen").alias("items_seen"), F.sum("items_new").alias("items_new")
        )
        runs = runs.join(totals, "id", "left")
    counters = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("items_seen", "items_new")}
    return runs.select(
        "id", "source_id", "start_time", "end_time", "status",
        counters["items_seen"].alias("items_processed"),
        "errors",
        F.to_json(F.struct(*counters.values())).alias("stats"),
        "config_snapshot",
    )


def append_error(errors: Column, at: Column, message: Column) -> Column:
    """Error list of a run row with one more entry; NULL starts a new list."""
    entry = F.struct(iso(at).alias("timestamp"), message.alias("error"))
    return F.array_append(F.coalesce(errors, F.array().cast(schemas.RUN_ERRORS)), entry)
