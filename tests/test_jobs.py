from __future__ import annotations

import pytest

from support import collected, listing
from ledgerleaf import __main__ as cli, jobs
from ledgerleaf.plans import reports
from ledgerleaf.sources.warehouse import Warehouse
from ledgerleaf.streaming.ingest import IngestJob


def test_command_line_round(spark, tmp_path, capsys):
    inbox, root = tmp_path / "pages", str(tmp_path / "wh")
    inbox.mkdir()
    (inbox / "T-Seite-1.html").write_text(listing(("A", "S", "Berlin"), ("B", "S", "Köln")))
    (inbox / "T-Seite-2.html").write_text(listing(("A", "S2", "Berlin")))
    for _ in range(2):
        cli.main([root, "ingest", str(inbox), "--source", "dir", "--url", "https://x.de"])
    places = str(tmp_path / "places")
    spark.createDataFrame([("Berlin", "BE")], "city string, state string").write.parquet(places)
    for _ in range(2):  # the second look-up replaces the first
        cli.main([root, "enrich", places, "--key", "address.city", "--reference-key", "city", "--take", "state",
                  "--kind", "geolocation", "--source", "places"])
    cli.main([root, "consolidate"])
    wh = Warehouse(spark, root)
    found = wh.read("enriched_data").join(wh.read("cleaned_data").selectExpr("id as cleaned_data_id", "name"), "cleaned_data_id")
    assert collected(found.select("name", "data", "confidence_score")) == [("A", '{"state":"BE"}', 1.0)] * 2
    assert wh.read("enriched_data").select("id").distinct().count() == 2
    sources, raw = wh.read("data_sources"), wh.read("raw_data")
    assert collected(sources.select("name", "url", "is_active")) == [("dir", "https://x.de", True)]
    assert raw.count() == 3 and wh.read("cleaned_data").count() == 3
    runs = wh.runs().orderBy("id").collect()
    assert [(r.id, r.status, r.items_processed, r.stats) for r in runs] == [
        (1, "completed", 3, '{"items_seen":3,"items_new":3}'), (2, "completed", 3, '{"items_seen":3,"items_new":0}'),
    ]
    assert all(r.end_time >= r.start_time and r.errors is None for r in runs)
    assert [r.source for r in reports.recent_runs(wh.runs(), sources).collect()] == ["dir", "dir"]
    masters = wh.read("master_records")
    assert collected(masters.select("name", "address.city", "sources", "confidence_score")) == [
        ("A", "Berlin", [sources.first().id], 1.0), ("B", "Köln", [sources.first().id], None),
    ]
    for name in cli.REPORTS:
        cli.main([root, "report", name, "--source", "dir"])
    cli.main([root, "verify", "listing_pages"])
    cli.main([root, "export", "cleaned_data", str(tmp_path / "out")])
    with pytest.raises(ValueError, match="cleaned_data"):
        cli.main([root, "truncate", "raw_data"])
    cli.main([root, "truncate", "raw_data", "--cascade"])
    assert "{'before': 3, 'after': 0, 'deleted': 3}" in capsys.readouterr().out
    cli.main([root, "reset"])
    cli.main([root, "create"])
    assert wh.read("cleaned_data").count() == 0


def test_a_failed_run_keeps_its_error(spark, tmp_path):
    job = IngestJob(Warehouse(spark, str(tmp_path / "wh")))
    bad = spark.createDataFrame([(1, "x")], "page_number int, html string").selectExpr(
        "page_number", "cast(raise_error('broken page') as string) as html")
    with pytest.raises(Exception, match="broken page"):
        jobs.run_ingest(job, bad, "dir", "u", {"k": 1})
    run = job.warehouse.runs().first()
    assert run.status == "running" and run.end_time is None and "broken page" in run.errors[0].error
    assert job.warehouse.read("raw_data").count() == 0 and job.warehouse.read("batches").count() == 0
    good = spark.createDataFrame([(1, listing(("A", "S", "C")))], "page_number int, html string")
    assert jobs.run_ingest(job, good, "dir", "u") == 2
    assert job.warehouse.read("data_sources").count() == 1


def test_a_text_wider_than_its_column_is_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_tables()
    for name, batch in (("x" * 255, 0), (None, 1)):
        wh.put("data_sources", spark.createDataFrame([(1, name, "u")], "id long, name string, url string"), batch)
    with pytest.raises(Exception, match="data_sources.name is longer than 255"):
        wh.put("data_sources", spark.createDataFrame([(1, "x" * 256, "u")], "id long, name string, url string"), 2)
    assert wh.read("data_sources").count() == 2
