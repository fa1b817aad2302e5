"""Physical plans: what is pushed down, what is shuffled, what never appears."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerleaf import registry
from ledgerleaf.operators import dedup, extract, ingest
from ledgerleaf.operators.joins import with_matching_ids
from ledgerleaf.plans import reports

DATA = "/root/testdata/sf0.001"
PYTHON = {"spaced_json_hash"}
#: Row-wise queries: nothing may be shuffled.
NO_SHUFFLE = {
    "clean_text", "content_hash", "domain_filter", "json_default", "length_rejects", "page_entries",
    "page_first_last", "page_links", "page_title", "parsed_entries", "search", "search_pattern", "source_names",
    "spaced_json_hash", "standardize", "union_rejects", "url_host_page", "validate",
    "validation_errors", "recent_records", "latest_json_sample",
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans for sides beyond the broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_every_plan(spark, name):
    text = physical(entry_point.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert name == "status_share" or not re.search(r"\bWindow\b", text)  # that one is over one row per status
    assert ("EvalPython" in text) == (name in PYTHON)
    if name in NO_SHUFFLE:
        assert "Exchange" not in text


def test_projection_and_filter_reach_the_scan(spark):
    text = physical(entry_point.queries()["raw_explorer"](spark, DATA))
    assert "EqualTo(event_type,click)" in text
    text = physical(entry_point.queries()["source_stats"](spark, DATA))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_nested_columns_are_pruned(spark, tmp_path, items, no_history):
    staged = items().withColumn("item_id", F.lit(1).cast("bigint"))
    staged.write.parquet(str(tmp_path / "staged"))
    stored = spark.read.schema(staged.schema).parquet(str(tmp_path / "staged"))
    text = physical(ingest.flag(stored).where("reason is null").select("hash", "item_id"))
    assert "html" not in re.search(r"ReadSchema: .*", text).group(0)


def test_top_k_does_not_sort_everything(spark):
    for name in ("recent_runs", "recent_records", "latest_json_sample"):
        text = physical(entry_point.queries()[name](spark, DATA))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_winners_and_history_share_one_shuffle(spark, no_broadcast, rows):
    df = rows("hash string, id bigint", ("a", 1))
    text = physical(dedup.drop_seen(dedup.first_ids(df, "hash", "id"), rows("hash string", ("a",))))
    assert text.count("Exchange hashpartitioning(hash") == 2  # one per input, none for the join
    assert "partial_min" in text


def test_hot_groups_are_reduced_before_the_shuffle(spark, rows):
    df = rows("hash string, id bigint, v string", ("a", 1, "x"))
    text = physical(dedup.first_wins(df, "hash", ["id"]))
    assert text.index("Exchange") < text.index("partial_min_by")  # children print below


def test_reports_reduce_facts_before_the_join(spark, no_broadcast, rows):
    text = physical(reports.source_stats(rows("id bigint, name string", (1, "a")),
                                         rows("id bigint, source_id bigint, scraped_at timestamp", (1, 1, None))))
    join = text.index("SortMergeJoin")
    assert "partial_count(id" in text[join:]


def test_matching_ids_are_planned_not_collected(rows):
    facts, ids = rows("k int", (1,), (2,), (9,)), rows("id int", (1,), (2,), (3,))
    kept = with_matching_ids(facts, "k", ids)
    assert "Join" in physical(kept)
    assert sorted(r.k for r in kept.collect()) == [1, 2]


def test_pages_are_read_once_and_natively(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select(
        F.lit(1).alias("source_id"), F.lit(1).alias("run_id"), F.lit(1).alias("page_number"), "html")
    text = physical(extract.listing_items(pages))
    assert not re.search("EvalPython|MapInArrow|PythonUDF", text) and text.count("FileScan") == 1
    assert text.count("regexp_extract_all(html") <= 1


def test_hot_rows_of_a_reduced_join_are_split(spark, no_broadcast):
    """A third of the rows under one key: the final plan must show a skew-split join."""
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000 + 10).cast("bigint").alias("g"),
            F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("v"),
        )
        kept = dedup.take_until_stop(rows, "g", ["n"], (F.col("n") == 150_000) | (F.col("n") % 5_000 == 20))
        got = kept.groupBy((F.col("g") == 7).alias("hot")).agg(F.count("*").alias("c"))
        counts = {r.hot: r.c for r in got.collect()}
        text = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    stops = {}
    for i in range(200_000):
        if i == 150_000 or i % 5_000 == 20:
            stops.setdefault(7 if i % 3 == 0 else i % 5_000 + 10, i)
    expected = {True: 0, False: 0}
    for i in range(200_000):
        g = 7 if i % 3 == 0 else i % 5_000 + 10
        expected[g == 7] += g not in stops or i <= stops[g]
    assert counts == expected
    assert "skew=true" in text


@pytest.mark.parametrize("key", ["ingest_raw", "ingest_rejects"])
def test_an_ingest_reads_each_input_once(spark, no_broadcast, key):
    """The batch and the history (documents that have labels) are parsed once each, sources read once."""
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry_point.queries()[key](spark, DATA)
        df.collect()
        final = physical(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold") if old is None else spark.conf.set(
            "spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", final)
    assert sorted(scans) == ["documents", "documents", "labels", "nation"]
    if key == "ingest_rejects":
        assert "ReusedExchange" in final
