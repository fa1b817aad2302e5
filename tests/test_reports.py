from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from support import collected
from ledgerleaf.plans import metrics, quality, reports

TS = "timestamp_ntz"


@pytest.fixture
def sources(rows):
    return rows("id bigint, name string", (1, "a"), (2, "b"), (3, "a"), (4, "empty"))


@pytest.fixture
def raw(spark):
    data = [(10, 1, "2024-01-01 23:59:59", "processed"), (11, 3, "2024-01-03 00:00:00", "failed"),
            (12, 2, "2024-01-02 12:00:00", "processed"), (13, None, "2024-01-02 13:00:00", "processed"),
            (14, 99, None, None)]
    df = spark.createDataFrame(data, "id bigint, source_id bigint, s string, processing_status string")
    return df.select("id", "source_id", F.col("s").cast("timestamp").alias("scraped_at"), "processing_status")


def test_overview(sources, raw):
    assert tuple(reports.overview(sources, raw, raw.limit(0)).first()) == (4, 5, 0)


def test_source_stats_merges_equal_names_and_keeps_empty_sources(sources, raw):
    got = {r.source: r for r in reports.source_stats(sources, raw).collect()}
    assert {k: r.records for k, r in got.items()} == {"a": 2, "b": 1, "empty": 0}
    assert got["empty"].first_scrape is None and got["empty"].last_scrape is None
    assert str(got["a"].first_scrape) == "2024-01-01 23:59:59" and str(got["a"].last_scrape) == "2024-01-03 00:00:00"
    assert collected(reports.source_counts(sources, raw)) == [("a", 2), ("b", 1), ("empty", 0)]


def test_find_and_sample(sources):
    assert reports.find(sources, name="b").first()["id"] == 2
    assert reports.find(sources, name="a").count() == 1 and reports.find(sources, id=9).first() is None
    assert reports.find(sources, id=3, name="a").count() == 1 and reports.find(sources, id=3, name="b").count() == 0
    assert reports.sample(sources, 3).count() == 3


def test_recent_runs_null_times_first_unknown_sources_out(rows, sources):
    runs = rows("id bigint, source_id bigint, start_time string, end_time string, status string, items_processed int",
                (1, 1, "2024-01-01", None, "running", 0), (2, 1, None, None, "running", 0),
                (3, 99, "2025-01-01", None, "running", 0), (4, None, "2025-01-01", None, "running", 0),
                (5, 2, "2024-01-01", None, "completed", 3))
    got = reports.recent_runs(runs, sources)
    assert got.columns == ["id", "source", "start_time", "end_time", "status", "items_processed"]
    assert [r.id for r in got.collect()] == [2, 5, 1]
    assert [r.id for r in reports.recent_runs(runs, sources, 1).collect()] == [2]


def test_raw_explorer(sources, raw):
    assert [r.id for r in reports.raw_explorer(raw, sources, "a").orderBy("id").collect()] == [10, 11]
    assert [r.id for r in reports.raw_explorer(raw, sources, "a", "failed").collect()] == [11]
    assert reports.raw_explorer(raw, sources, "nobody").count() == 0
    assert reports.raw_explorer(raw, sources, "a' or '1'='1").count() == 0


def test_cleaned_explorer(rows, sources):
    cleaned = rows("id bigint, source_id bigint, name string, category string, validation_status string",
                   (1, 1, "n", "c", "valid"), (2, 1, "m", "c", None))
    assert [r.id for r in reports.cleaned_explorer(cleaned, sources, "a", "valid").collect()] == [1]
    assert reports.cleaned_explorer(cleaned, sources, "a").count() == 2


def test_search(rows):
    masters = rows("id int, name string, external_id string, updated_at string",
                   (1, "abc", "x", "2024-01-01"), (2, "A_C", "y", None), (3, None, "zABCz", "2024-01-02"),
                   (4, "100%", "q", "2024-01-02"), (5, "axxc", None, "2023-01-01"))
    ids = lambda term: sorted(r.id for r in reports.search(masters, term).collect())
    assert ids("abc") == [1, 3]
    assert ids("a_c") == [1, 2, 3]
    assert ids("a%c") == [1, 2, 3, 5]
    assert ids(r"\%") == [4]
    assert [r.id for r in reports.search(masters, "", n=3).collect()] == [2, 4, 3]


def test_per_day_nulls_last(raw):
    got = [(str(r.date), r["count"]) for r in reports.records_per_day(raw).collect()]
    assert got == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 1), ("None", 1)]


def test_status_distribution_keeps_null(raw):
    got = reports.status_distribution(raw, "processing_status")
    assert collected(got) == [(None, 1), ("failed", 1), ("processed", 3)]
    share = reports.status_share(raw, "processing_status")
    assert {r.processing_status: r.share for r in share.collect()} == {None: 0.2, "failed": 0.2, "processed": 0.6}


def test_bound_parameters(spark, sources):
    sources.createOrReplaceTempView("t_sources")
    got = reports.run_sql(spark, "select id from t_sources where name = :n order by id", n="a")
    assert collected(got) == [(1,), (3,)]
    assert [r.name for r in reports.source_names(sources).collect()] == ["a", "b", "a", "empty"]


def test_quality_report(rows):
    df = rows("id int, url string, title string, metadata string",
              (1, "u", "t1", '{"page_number": 2, "address": {"city": "Köln"}}'), (2, "u", "t2", '{"page_number": "2"}'),
              (3, "v", "t3", '{"page_number": null}'), (4, "w", "t4", "{}"), (5, "x", "t5", '{"page_number": "abc"}'),
              (6, "y", "t6", '{"page_number": 1}'))
    got = quality.quality_report(df)
    assert got["total"].first()[0] == 6
    assert [tuple(r) for r in got["per_page"].collect()] == [(1, 1), (2, 2), (None, 1)]
    assert quality.bad_json_ints(df, "metadata", "$.page_number").first()[0] == 1
    assert collected(got["duplicates"]) == [("u", 2)]
    assert [tuple(r) for r in got["latest"].collect()][-1] == (2, "t2", "2", None)
    with pytest.raises(PySparkException):
        quality.count_by_json_int(df, "metadata", "$.page_number", strict=True).collect()


def test_metrics(rows):
    runs = rows("id int, start_time string, end_time string", (1, "2024-01-01 00:00:00", "2024-01-01 00:01:30"),
                (2, "2024-01-01 00:00:00", None))
    runs = runs.withColumns({c: F.col(c).cast("timestamp") for c in ("start_time", "end_time")})
    assert collected(metrics.run_duration(runs)) == [(1, 90), (2, None)]
    raw = rows("run_id int, s string", (1, "processed"), (1, "failed"), (2, "failed"), (1, None))
    got = metrics.success_rate(raw, F.col("run_id"), "run_id", F.col("s") == "processed")
    assert collected(got) == [(1, 3, 1, 1 / 3), (2, 1, 0, 0.0)]
    fields = rows("h string, a string, b string", ("x", "1", " "), ("x", None, "2"), ("y", "", None))
    assert collected(metrics.quality_score(fields, "h", ["a", "b"])) == [("x", 2, 2, 0.5), ("y", 1, 0, 0.0)]


def test_lineage(rows, sources):
    runs = rows("id bigint, source_id bigint", (1, 1), (2, 1), (3, 2))
    raw = rows("id bigint, run_id bigint", (1, 1), (2, 1), (3, 3), (4, None))
    cleaned = rows("id bigint, raw_data_id bigint", (1, 1), (2, 3))
    enriched = rows("id bigint, cleaned_data_id bigint", (1, 1), (2, 1))
    got = metrics.lineage_counts(sources, runs, raw, cleaned, enriched)
    assert collected(got) == [(1, "a", 2, 2, 1, 2), (2, "b", 1, 1, 1, 0), (3, "a", 0, 0, 0, 0), (4, "empty", 0, 0, 0, 0)]
    chain = metrics.lineage_rows(sources, runs, raw, cleaned, enriched)
    assert collected(chain, "source_id", "run_id", "raw_data_id", "enriched_data_id") == [
        (1, "a", 1, 1, 1, 1), (1, "a", 1, 1, 1, 2), (1, "a", 1, 2, None, None), (1, "a", 2, None, None, None),
        (2, "b", 3, 3, 2, None), (3, "a", None, None, None, None), (4, "empty", None, None, None, None),
    ]


def test_hot_source_of_lineage_rows_is_split(spark):
    """A third of the raw rows under one run: the final plan must show a skew-split join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(300_000, numPartitions=8)
        sources = spark.range(10).select("id", F.concat(F.lit("s"), "id").alias("name"))
        runs = spark.range(2_000).select("id", (F.col("id") % 10).alias("source_id"))
        raw = ids.select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1_500).alias("run_id"))
        cleaned = ids.where("id % 2 = 0").select("id", F.col("id").alias("raw_data_id"))
        enriched = spark.range(5).select("id", F.col("id").alias("cleaned_data_id"))
        rows = metrics.lineage_rows(sources, runs, raw, cleaned, enriched)
        counted = rows.agg(*[F.count(c).alias(c) for c in rows.columns], F.count("*").alias("n"))
        got = counted.collect()[0]
        text = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (got.n, got.raw_data_id, got.cleaned_data_id, got.enriched_data_id) == (301_000, 300_000, 150_000, 3)
    assert "skew=true" in text
