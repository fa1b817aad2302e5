"""A corpus pipeline: reject poor documents, keep one of each near-duplicate class, drop leaked ones, redact, mix.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; each result
is written to the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm import decontaminate, jaccard_join, personal_data, quality_mil, source_mix
from ledgerleaf.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_mil.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~quality_mil.held_out())
    return quality_mil.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of least id."""
    return jaccard_join.one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return personal_data.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_mix.mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("redaction", redaction),
    ("mixing", mixing),
]

#: A trained classifier and the classes of near duplicates are beyond SQL; tests/llm checks the
#: pipeline against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
