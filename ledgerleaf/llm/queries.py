"""The operators of this subpackage over the driver tables, one query each, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (
    collision_search, decontaminate, filter_audit, jaccard_join, license_scan, ngram_lm, personal_data, quality_mil, source_mix,
    spelling_variants, suffix_dedup, token_counts, url_filter,
)

#: Vocabulary of the token counts; another place is set with ``token_counts.token_counts(model_path=...)``.
VOCABULARY = "piece_bpe_32k.model"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _documents(fn: Callable[..., DataFrame], *more: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: fn(*(_read(spark, folder, t) for t in ("documents", *more)))


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_read(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate.contaminated(docs, benchmark).drop("text_hash")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_score": _documents(ngram_lm.op1),
    "op2_quality_mil": _documents(quality_mil.op2, "labels"),
    "op3_decontaminate": _documents(_leaks, "benchmark"),
    "op4_source_mix": _documents(source_mix.op4),
    "op5_personal_data": _documents(personal_data.op5),
    "op6_license_scan": _documents(license_scan.license_scan),
    "op7_collision_search": lambda spark, folder: collision_search.nearest_vectors(_read(spark, folder, "embeddings")),
    "op8_jaccard_join": _documents(jaccard_join.op8),
    "op9_suffix_dedup": _documents(suffix_dedup.op9),
    "op10_token_counts": _token_counts,
    "op11_filter_audit": _documents(filter_audit.op11, "labels"),
    "op12_spelling_variants": _documents(spelling_variants.op12),
    "op13_url_filter": lambda spark, folder: url_filter.op13(_read(spark, folder, "pages")),
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op4_source_mix": source_mix.OP4_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_spelling_variants": spelling_variants.OP12_SQL,
    "op13_url_filter": url_filter.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
