from __future__ import annotations

import dataclasses
import time

import pytest
from pyspark.sql import functions as F

from support import collected, listing
from ledgerleaf import jobs, schemas
from ledgerleaf.operators import extract, ledger
from ledgerleaf.operators.validate import ValidationRules
from ledgerleaf.sources.warehouse import Warehouse
from ledgerleaf.streaming import dedup, ingest as ingest_module, progress
from ledgerleaf.streaming.ingest import IngestJob, load_batch, load_items, start_ingest

PAGES = [
    (1, 1, 1, "p1", listing(("A", "S", "C"), ("B", "S", "C"))),
    (1, 1, 2, "p2", listing(("C", "S", "C"))),
    (1, 2, 1, "p1", listing(("A", "S", "C"), ("new", "S", "C"))),
    (9, 2, 1, "px", listing(("unknown source", "S", "C"))),
    (1, 2, 3, "p3", listing(("x" * 300, "S", "C"))),
    (1, 7, 1, "p4", listing(("unknown run", "S", "C"))),
]


def job(spark, root, **options) -> IngestJob:
    wh = Warehouse(spark, str(root / "wh"))
    wh.create_tables()
    wh.put("data_sources", spark.createDataFrame([(1, "dir", "u")], "id bigint, name string, url string"), 0)
    wh.put("run_changes", ledger.open_run(spark, 1, 1).unionByName(ledger.open_run(spark, 2, 1)), 0)
    return IngestJob(wh, **options)


def frame(spark, data):
    return spark.createDataFrame(data, schemas.PAGES)


def contents(wh: Warehouse) -> dict[str, list]:
    return {
        "raw": collected(wh.read("raw_data").select("source_id", "run_id", "raw_content.name", "hash",
                                                    "processing_status")),
        "cleaned": collected(wh.read("cleaned_data").select("name", "address.city", "validation_status")),
        "rejects": collected(wh.read("rejected_items").select("source_id", "reason")),
        "runs": collected(wh.read("run_progress").groupBy("id").agg(F.sum("items_seen"), F.sum("items_new"))),
    }


@pytest.fixture
def expected(spark, tmp_path):
    whole = job(spark, tmp_path / "whole", probe_history=False)
    load_batch(whole, frame(spark, PAGES), 0)
    return contents(whole.warehouse)


def test_one_batch(expected):
    assert [r[2] for r in expected["raw"]] == ["A", "B", "C", "new"]
    assert {r[4] for r in expected["raw"]} == {"processed"}
    assert [r[0] for r in expected["cleaned"]] == ["A", "B", "C", "new"]
    assert expected["rejects"] == [(1, "too_long:name"), (1, "unknown_run"), (9, "unknown_source")]
    assert expected["runs"] == [
        (1, 3, 3), (2, 4, 1), (7, 1, 0),
    ]


def test_batches_and_replays_give_the_same_tables(spark, tmp_path, expected):
    parts = job(spark, tmp_path, validation=None)
    wh = parts.warehouse
    load_batch(parts, frame(spark, PAGES[:2]), 0)
    load_batch(parts, frame(spark, PAGES[2:]), 1)
    assert contents(wh) == expected
    ids = {r.id: r.hash for r in wh.read("raw_data").collect()}
    assert len(ids) == 4
    for batch, data in ((1, PAGES[2:]), (0, PAGES[:2])):
        load_batch(parts, frame(spark, data), batch)
        assert contents(wh) == expected
    linked = wh.read("cleaned_data").join(
        wh.read("raw_data").select(F.col("id").alias("raw_data_id"), "raw_content"), "raw_data_id")
    assert linked.where("name = raw_content.name").count() == 4
    batches = wh.read("batches").orderBy("seq").collect()
    assert [(b.items_seen, b.raw_rows, b.cleaned_rows, b.rejected_rows) for b in batches] == [(3, 3, 3, 0), (5, 1, 1, 3)]
    assert batches[1].max_raw_id > batches[0].max_raw_id


@pytest.mark.parametrize("table", ["raw_data", "cleaned_data", "batches"])
def test_a_batch_that_broke_off_is_replayed(spark, tmp_path, expected, monkeypatch, table):
    broken = job(spark, tmp_path)
    load_batch(broken, frame(spark, PAGES[:2]), 0)
    write = Warehouse.write

    def fail(self, name, df, batch_id):
        if name == table:
            raise RuntimeError("lost")
        return write(self, name, df, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "write", fail)
        with pytest.raises(RuntimeError):
            load_batch(broken, frame(spark, PAGES[2:]), 1)
    load_batch(broken, frame(spark, PAGES[2:]), 1)
    assert contents(broken.warehouse) == expected


@pytest.mark.parametrize("table", ["cleaned_data", "run_progress", "batches"])
def test_an_unfinished_batch_is_not_read(spark, tmp_path, monkeypatch, table):
    broken = job(spark, tmp_path)
    load_batch(broken, frame(spark, PAGES[:2]), 0)
    seen = contents(broken.warehouse)
    write = Warehouse.write

    def fail(self, name, df, batch_id):
        if name == table:
            raise RuntimeError("lost")
        return write(self, name, df, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "write", fail)
        with pytest.raises(RuntimeError):
            load_batch(broken, frame(spark, PAGES[2:]), broken.warehouse.batch_id("run", 1))
    assert broken.warehouse.batch("raw_data", 1).count() == 0
    assert contents(broken.warehouse) == seen
    # another writer goes on under an id of its own, and the same content is new to it
    assert broken.warehouse.batch_id("run", 2) == 2
    load_batch(broken, frame(spark, PAGES[2:]), 2)
    assert [r[2] for r in contents(broken.warehouse)["raw"]] == ["A", "B", "C", "new"]
    # the replay under the old id then finds it in the later batch
    load_batch(broken, frame(spark, PAGES[2:]), broken.warehouse.batch_id("run", 1))
    assert [r[2] for r in contents(broken.warehouse)["raw"]] == ["A", "B", "C", "new"]
    ids = [r.id for r in broken.warehouse.read("raw_data").collect()]
    assert len(ids) == len(set(ids))


def test_a_stream_and_runs_take_turns(spark, tmp_path):
    inbox, shared = str(tmp_path / "inbox"), job(spark, tmp_path)
    names = lambda: [r[2] for r in contents(shared.warehouse)["raw"]]

    def stream(name):
        frame(spark, [(1, 1, 1, "p", listing((name, "S", "C")))]).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(schemas.PAGES).parquet(inbox)
        assert start_ingest(shared, source, str(tmp_path / "cp"), availableNow=True).awaitTermination(300)

    def run(name):
        pages = spark.createDataFrame([(1, listing((name, "S", "C")))], "page_number int, html string")
        jobs.run_ingest(shared, pages, "dir", "u")

    run("a")
    stream("b")
    run("c")
    stream("d")
    assert sorted(names()) == ["a", "b", "c", "d"]
    assert [r.seq for r in shared.warehouse.read("batches").orderBy("seq").collect()] == [0, 1, 2, 3]


def test_two_warehouses_at_once(spark, tmp_path):
    one, two = job(spark, tmp_path / "one"), job(spark, tmp_path / "two")
    assert one.staging(0) != two.staging(0) and one.shared("ingest_stream") != two.shared("ingest_stream")


def test_a_page_that_cannot_be_read_becomes_a_failed_row(spark, tmp_path):
    failing = job(spark, tmp_path)
    pages = [(1, 1, 1, "p1", listing(("A", "S", "C"))), (1, 1, 3, "p3", None), (1, 1, 4, "p4", listing(("B", "S", "C")))]
    items = extract.listing_items(frame(spark, pages)).withColumn("page_error", F.lit(None).cast("string"))
    torn = spark.createDataFrame([(1, 1, "p2", "ValueError: unreadable")], "source_id long, run_id long, url string, page_error string")
    load_items(failing, items.unionByName(torn, allowMissingColumns=True), 0)
    rows = failing.warehouse.read("raw_data").where("error is not null").collect()
    assert [(r.source_id, r.run_id, r.url, r.error, r.processing_status, r.hash) for r in rows] == [
        (1, 1, "p2", "ValueError: unreadable", "failed", None)]
    assert [r[0] for r in contents(failing.warehouse)["cleaned"]] == ["A", "B"]
    assert contents(failing.warehouse)["runs"] == [(1, 2, 2)]


def test_the_history_does_not_move(spark, tmp_path):
    one = job(spark, tmp_path)
    load_batch(one, frame(spark, PAGES[:2]), 0)
    items = spark.range(50_000).select(F.md5(F.col("id").cast("string")).alias("hash"))
    history = one.warehouse.others("raw_data", 7).select("hash")
    plans = []

    def explained(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path)

    stored = ingest_module._staged
    try:
        ingest_module._staged = explained
        assert ingest_module._seen(one, items, history, 7).count() == 0
    finally:
        ingest_module._staged = stored
    assert "BroadcastHashJoin" in plans[1] and "SortMergeJoin" not in plans[1]


def test_items_of_all_batches_are_reported(spark, tmp_path):
    told = []
    watched = job(spark, tmp_path, report=told.append, report_every=3)
    for batch, data in enumerate((PAGES[:1], PAGES[:2])):  # 2 and 3 items
        load_batch(watched, frame(spark, data), batch)
    assert told == [5]
    assert [r.items_seen for r in watched.warehouse.read("batches").orderBy("seq").collect()] == [2, 3]


def test_an_empty_page_ends_a_listing_for_later_batches(spark, tmp_path):
    stopping = job(spark, tmp_path, stop_at_empty=True)
    wh = stopping.warehouse
    page = lambda run, number, name: (1, run, number, "p", listing((name, "S", "C")) if name else "<html></html>")
    load_batch(stopping, frame(spark, [page(1, 1, "a"), page(1, 3, None), page(1, 4, "late"), page(2, 4, "b")]), 0)
    load_batch(stopping, frame(spark, [page(1, 2, "c"), page(1, 9, "suppressed"), page(2, 9, "d"), page(1, 5, None)]), 1)
    assert [r[0] for r in contents(wh)["cleaned"]] == ["a", "b", "c", "d"]
    assert collected(wh.read("page_stops").select("source_id", "run_id", "page_number")) == [(1, 1, 3)]
    assert [r.items_seen for r in wh.read("batches").orderBy("seq").collect()] == [2, 2]


def test_rules_of_a_stored_source_change_what_is_written(spark, tmp_path):
    ruled = job(spark, tmp_path)
    config = '{"rules": {"name": [{"op": "upper"}], "address.city": [{"op": "constant", "value": "Town"}]}}'
    ruled.warehouse.put("data_sources", spark.createDataFrame(
        [(1, "dir", "u", config), (2, "other", "v", None)], "id bigint, name string, url string, config string"), 0)
    load_batch(ruled, frame(spark, [(1, 1, 1, "p", listing(("abc", "S", "C"))), (2, 1, 1, "p", listing(("def", "S", "C")))]), 0)
    rows = ruled.warehouse.read("cleaned_data").select("source_id", "name", "address.city", "address.street")
    assert collected(rows) == [(1, "ABC", "Town", "S"), (2, "def", "C", "S")]
    assert collected(ruled.warehouse.read("raw_data").select("raw_content.name")) == [("abc",), ("def",)]


def test_empty_batch(spark, tmp_path):
    empty = job(spark, tmp_path)
    load_batch(empty, frame(spark, PAGES[:1]), 0)
    load_batch(empty, frame(spark, [(1, 1, 3, "p3", "<html></html>")]), 1)
    rows = empty.warehouse.read("batches").orderBy("seq").collect()
    assert (rows[1].items_seen, rows[1].raw_rows) == (0, 0) and rows[1].max_raw_id == rows[0].max_raw_id


def test_validation_in_the_pipeline(spark, tmp_path):
    checked = job(spark, tmp_path, validation=ValidationRules())
    load_batch(checked, frame(spark, [(1, 1, 1, "p", listing(("A", "S", "C"), ("B", "S", "")))]), 0)
    assert [r[2] for r in contents(checked.warehouse)["cleaned"]] == ["valid", "partial"]


def test_stream_equals_batch(spark, tmp_path, expected):
    inbox = str(tmp_path / "inbox")
    streamed = job(spark, tmp_path)

    def arrive(data):
        frame(spark, data).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        source = spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", 1).parquet(inbox)
        query = start_ingest(streamed, source, str(tmp_path / "cp"), availableNow=True)
        assert query.awaitTermination(300)

    arrive(PAGES[:2])
    run()
    arrive(PAGES[2:4])
    time.sleep(1.1)  # file sources order by modification time
    arrive(PAGES[4:])
    run()
    assert contents(streamed.warehouse) == expected
    assert streamed.warehouse.read("batches").count() == 3
    run()
    assert contents(streamed.warehouse) == expected


def test_progress(spark, tmp_path):
    df, seen = progress.observed(spark.range(250), "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 250}

    reports = []
    listener = progress.ProgressListener(step=100, report=reports.append)
    spark.streams.addListener(listener)
    try:
        for n in (90, 30, 5, 200):
            spark.range(n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            time.sleep(1.1)
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = progress.counted(stream).writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(300)
        for _ in range(50):
            if listener.total == 325:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.total == 325 and reports == [120, 325]


@pytest.mark.parametrize("unique", [
    dedup.unique_by_hash, lambda s: dedup.unique_within(s, "at", "1 hour"),
])
def test_stream_dedup(spark, tmp_path, unique):
    data = [("a", 0), ("b", 1), ("a", 2), ("a", 3), ("b", 4)]
    for i, part in enumerate((data[:3], data[3:])):
        df = spark.createDataFrame(part, "hash string, n int").withColumn("at", F.timestamp_seconds("n"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1 * (1 - i))
    stream = spark.readStream.schema("hash string, n int, at timestamp").option(
        "maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = unique(stream).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    assert query.awaitTermination(300)
    assert collected(spark.read.parquet(str(tmp_path / "out")).select("hash")) == [("a",), ("b",)]
