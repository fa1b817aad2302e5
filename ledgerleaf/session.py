"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings the plans in this package are written for.  Joins outside ``llm`` carry no
#: broadcast hints: Catalyst (from file sizes) and AQE (from shuffle sizes) broadcast a side
#: only while it is under the thresholds and fall back to a shuffle join beyond.
SCALE_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Page bodies are fat: bound an Arrow batch by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def get_session(app: str = "ledgerleaf", master: str | None = None, **confs: str) -> SparkSession:
    """Session with :data:`SCALE_CONFS`; ``confs`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONFS.items():
        builder = builder.config(key, value)
    for key, value in confs.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Days and durations are defined in UTC whatever session a caller brings."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder every executor reaches, for staged tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  ``fallback`` counts only where
    that is unset (tests); a machine-local default is never made up.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return path.rstrip("/")
