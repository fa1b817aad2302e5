"""Versions, compaction and truncation of the stored tables."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from support import collected, listing
from ledgerleaf import jobs, schemas
from ledgerleaf.sources import manifest
from ledgerleaf.sources.warehouse import Warehouse, Written
from ledgerleaf.streaming.ingest import IngestJob


@pytest.fixture
def warehouse(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_tables()
    return wh


@pytest.fixture
def run(spark, warehouse):
    """run("A", "B"): ingest a page with these entries as one run; returns the job."""
    job = IngestJob(warehouse)

    def ingest(*names):
        pages = spark.createDataFrame([(1, listing(*[(n, "S", "C") for n in names]))], "page_number int, html string")
        jobs.run_ingest(job, pages, "dir", "u")
        return job

    return ingest


def names(wh, **at):
    return sorted(r[0] for r in wh.read("cleaned_data", **at).select("name").collect())


def page_rows(spark, batch, n=3):
    return spark.range(n).select((F.col("id") + batch * n + 1).alias("id"), F.lit(f"u{batch}").alias("url"))


def test_readers_open_only_named_files(warehouse, spark):
    warehouse.put("listing_pages", page_rows(spark, 0), 0)
    folder = os.path.join(warehouse.root, "listing_pages", "stray")
    page_rows(spark, 9).withColumn("batch_id", F.lit(9)).write.parquet(folder)
    assert warehouse.read("listing_pages").count() == 3 and warehouse.next_batch("listing_pages") == 1
    named = {f"{warehouse.root}/{f.path}" for f in warehouse.files("listing_pages")}
    assert {p.removeprefix("file://") for p in warehouse.read("listing_pages").inputFiles()} == named


def test_two_hundred_batches_compact_under_a_reader(warehouse, spark):
    batch = F.floor((F.col("id") - 1) / 3)
    rows = spark.range(1, 601).select("id", F.concat(F.lit("u"), batch).alias("url"), batch.alias("batch_id"))
    columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in warehouse.schema("listing_pages").fields]
    files = warehouse._store("listing_pages", rows.repartitionByRange(200, "batch_id").select(*columns))
    warehouse.commit(Written("listing_pages", tuple(files), None))
    reader, version = warehouse.read("listing_pages"), warehouse.version()
    before = collected(reader.select("id", "url", "batch_id"))
    assert len(warehouse.files("listing_pages")) == 200 and len(before) == 600

    assert warehouse.compact("listing_pages") == {"listing_pages": (200, 1)}
    assert collected(reader.select("id", "url", "batch_id")) == before, "a running reader keeps its files"
    assert collected(warehouse.read("listing_pages").select("id", "url", "batch_id")) == before
    assert warehouse.batch("listing_pages", 77).count() == 3 and warehouse.next_batch("listing_pages") == 200
    assert warehouse.last_id("listing_pages") == 600
    # a batch in a merged file is replaced alone
    warehouse.put("listing_pages", page_rows(spark, 77, 1), 77)
    assert warehouse.batch("listing_pages", 77).count() == 1 and warehouse.read("listing_pages").count() == 598
    assert warehouse.read("listing_pages", version).count() == 600, "earlier versions can be read"

    assert warehouse.vacuum(keep=1, min_age=3600) == 0 and warehouse.vacuum(keep=1, min_age=-60) >= 201
    assert warehouse.read("listing_pages").count() == 598 and warehouse.compact("listing_pages")["listing_pages"][1] == 1


def test_compaction_splits_by_batch(warehouse, spark):
    for batch in range(6):
        warehouse.put("listing_pages", page_rows(spark, batch, 400), batch)
    size = sum(f.bytes for f in warehouse.files("listing_pages"))
    warehouse.compact("listing_pages", target_bytes=size // 2)
    files = warehouse.files("listing_pages")
    assert len(files) < 6 * 4 and max(f.last_batch - f.first_batch for f in files) < 5
    assert warehouse.read("listing_pages").count() == 2400


def test_a_change_that_lost_its_files_is_refused(warehouse, spark):
    for batch in range(2):
        warehouse.put("listing_pages", page_rows(spark, batch), batch)
    files = warehouse.files("listing_pages")
    warehouse.truncate("listing_pages")
    with pytest.raises(manifest.Conflict):
        warehouse.commit(merged=files)
    with pytest.raises(manifest.Conflict):
        manifest.publish(spark, warehouse.place, warehouse.version(), [])


def test_a_version_that_broke_off_is_passed_over(warehouse, spark):
    warehouse.put("listing_pages", page_rows(spark, 0), 0)
    os.makedirs(os.path.join(warehouse.root, "_live", f"version={warehouse.version() + 1}", "_temporary"))
    assert warehouse.read("listing_pages").count() == 3
    warehouse.put("listing_pages", page_rows(spark, 1), 1)
    assert warehouse.read("listing_pages").count() == 6


@pytest.mark.parametrize("table", ["data_sources", "run_changes", "raw_data", "cleaned_data", "batches", "run_progress"])
def test_loading_after_any_truncate_loses_nothing(run, warehouse, table):
    run("A", "B")
    warehouse.truncate(table, cascade=True)
    left = names(warehouse)
    run("C")
    assert names(warehouse) == sorted([*left, "C"])
    ids = [r.id for r in warehouse.read("raw_data").collect()]
    assert len(ids) == len(set(ids)) and "C" in names(warehouse)


def test_truncate_of_parents_and_children_restarts_ids(run, warehouse):
    run("A", "B")
    run("C")
    for table in ("raw_data", "run_changes", "data_sources", "batches", "batch_starts"):
        with pytest.raises(ValueError, match="refer to"):
            warehouse.truncate(table)
    report = warehouse.truncate("raw_data", "cleaned_data")
    assert list(report) == ["cleaned_data", "raw_data"] and report["raw_data"] == {"before": 3, "after": 0, "deleted": 3}
    run("A")
    assert [r.id for r in warehouse.read("raw_data").collect()] == [1] and names(warehouse) == ["A"]
    assert warehouse.runs().count() == 3
    assert set(warehouse.truncate("data_sources", "batches", cascade=True)) >= {"data_sources", "raw_data", "run_changes", "batch_starts"}
    run("A")
    assert [r.id for r in warehouse.runs().collect()] == [1] and warehouse.read("batches").first().seq == 0


def test_a_stored_table_moves_with_its_folder(run, warehouse, spark, tmp_path):
    run("A", "B")
    os.rename(warehouse.root, tmp_path / "moved")
    assert names(Warehouse(spark, str(tmp_path / "moved"))) == ["A", "B"]


def test_a_stored_upsert_touches_changed_rows_and_their_files_alone(spark, tmp_path):
    job = IngestJob(Warehouse(spark, str(tmp_path / "wh")))
    wh, old, new = job.warehouse, datetime(2020, 1, 1), datetime(2021, 1, 1)
    ddl = "id bigint, name string, url string, config string, created_at timestamp, updated_at timestamp"
    wh.put("data_sources", spark.createDataFrame([(1, "a", "u", "x", old, old), (2, "b", "u", "x", old, old)], ddl).coalesce(1), 0)
    wh.put("data_sources", spark.createDataFrame([(3, "c", "u", "x", old, old)], ddl), 1)
    before = {f.path for f in wh.files("data_sources") if f.first_batch == 1}
    changes = spark.createDataFrame([("b", None, "y"), ("d", "v", None)], "name string, url string, config string")
    wh.upsert("data_sources", changes, "name", at=new)
    got = {r.name: r for r in wh.read("data_sources").collect()}
    assert {n: (r.id, r.url, r.config, r.updated_at) for n, r in got.items() if n != "d"} == {
        "a": (1, "u", "x", old), "b": (2, "u", "y", new), "c": (3, "u", "x", old)}
    assert got["b"].created_at == old and (got["d"].created_at, got["d"].updated_at, got["d"].is_active) == (new, new, True)
    assert got["d"].id > 3 and [got[n].batch_id for n in "abcd"] == [0, 0, 1, 2]
    assert before < {f.path for f in wh.files("data_sources")}
    jobs.change_sources(job, changes.where("name = 'nobody'"))
    assert wh.read("data_sources").count() == 4
    empty = IngestJob(Warehouse(spark, str(tmp_path / "empty")))
    jobs.change_sources(empty, changes.where("name = 'd'"))
    assert empty.warehouse.read("data_sources").count() == 1
