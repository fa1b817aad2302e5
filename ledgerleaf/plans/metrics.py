"""Run metrics: success rate, processing time, quality score, lineage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf.functions import text as X


def success_rate(df: DataFrame, group: Column, name: str, success: Column) -> DataFrame:
    """Rows, successes and their ratio per group (integer counts, one division)."""
    counts = df.groupBy(group.alias(name)).agg(
        F.count("*").alias("total"), F.count_if(success).alias("succeeded")
    )
    return counts.withColumn("rate", F.col("succeeded") / F.col("total").cast("double"))


def run_duration(runs: DataFrame) -> DataFrame:
    """Whole seconds from start to end per run; NULL while a run is open."""
    seconds = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    return runs.select("id", seconds.alias("seconds"))


def quality_score(df: DataFrame, group: str, fields: list) -> DataFrame:
    """Mean share of non-blank fields per group."""
    filled = df.groupBy(group).agg(
        F.count("*").alias("records"), F.sum(X.filled_share(fields)).alias("filled")
    )
    return filled.withColumn(
        "score", F.col("filled") / (F.col("records") * F.lit(len(fields))).cast("double")
    )


def lineage_counts(sources: DataFrame, runs: DataFrame, raw: DataFrame, cleaned: DataFrame,
                   enriched: DataFrame) -> DataFrame:
    """Runs, raw, cleaned and enriched rows per source along the chain of keys.

    Each level is reduced to its parent's key before it joins the parent, bottom up.
    """
    per_cleaned = enriched.groupBy(F.col("cleaned_data_id").alias("_k")).agg(F.count("*").alias("_e"))
    per_raw = _roll_up(cleaned.select("id", F.col("raw_data_id").alias("_p")), per_cleaned, "_c", ["_e"])
    per_run = _roll_up(raw.select("id", F.col("run_id").alias("_p")), per_raw, "_r", ["_c", "_e"])
    per_source = _roll_up(runs.select("id", F.col("source_id").alias("_p")), per_run, "_n",
                          ["_r", "_c", "_e"])
    joined = sources.select("id", "name").join(per_source, F.col("id") == F.col("_k"), "left")
    count = lambda c, name: F.coalesce(F.col(c), F.lit(0)).alias(name)
    return joined.select("id", "name", count("_n", "runs"), count("_r", "raw"),
                         count("_c", "cleaned"), count("_e", "enriched"))


def _roll_up(level: DataFrame, below: DataFrame, count: str, sums: list[str]) -> DataFrame:
    """Count ``level`` rows per parent and sum what the level below counted."""
    joined = level.join(below, F.col("id") == F.col("_k"), "left")
    return joined.groupBy(F.col("_p").alias("_k")).agg(
        F.count("*").alias(count), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    )


def lineage_rows(sources: DataFrame, runs: DataFrame, raw: DataFrame, cleaned: DataFrame,
                 enriched: DataFrame) -> DataFrame:
    """The chain as rows: every source with its runs, raw, cleaned and enriched ids.

    Built from the bottom up.  At each level the rows below meet their parents in an inner join
    with the rows on the left, whose hot partitions AQE splits; parents without rows below are
    found against the distinct keys of the level below, and added.
    """
    chain = (
        (cleaned, "cleaned_data_id", "raw_data_id", enriched),
        (raw, "raw_data_id", "run_id", cleaned),
        (runs, "run_id", "source_id", raw),
        (sources, "source_id", "name", runs),
    )
    rows = enriched.select(F.col("cleaned_data_id").alias("_parent"), F.col("id").alias("enriched_data_id"))
    for parents, key, above, children in chain:
        level = parents.select(F.col("id").alias(key), F.col(above).alias("_above"))
        taken = [c for c in rows.columns if c != "_parent"]
        matched = rows.join(level, F.col("_parent") == F.col(key)).select("_above", key, *taken)
        held = children.select(F.col(key).alias("_parent")).distinct()
        childless = level.join(held, F.col(key) == F.col("_parent"), "left_anti")
        rows = matched.unionByName(childless, allowMissingColumns=True).withColumnRenamed("_above", "_parent")
    return rows.select(
        "source_id", F.col("_parent").alias("source"),
        "run_id", "raw_data_id", "cleaned_data_id", "enriched_data_id",
    )
