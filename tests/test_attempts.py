from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from support import collected, listing
from ledgerleaf import __main__ as cli, jobs, schemas
from ledgerleaf.operators import attempts
from ledgerleaf.sources.warehouse import Warehouse
from ledgerleaf.streaming.ingest import IngestJob

NOON = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
PAGES = "page_number int, url string, html string, status int, error string"


@pytest.fixture
def job(spark, tmp_path):
    return IngestJob(Warehouse(spark, str(tmp_path / "wh")))


def page(number, name=None, status=None, error=None):
    return (number, f"u{number}", listing((name, "S", "C")) if name else None, status, error)


def numbers(df):
    return [r[0] for r in df.select("page_number").orderBy("page_number").collect()]


def load(job, *data, minutes=0, **options):
    frame = job.warehouse.spark.createDataFrame(list(data), PAGES)
    return jobs.run_ingest(job, frame, "dir", "u", at=NOON + timedelta(minutes=minutes), **options)


def test_outcomes(rows):
    data = [(1, "<p>", 200, None), (2, "<p>", 503, None), (3, None, 404, None), (4, None, None, None), (5, "<p>", None, "timed out"),
            (6, "", None, None)]
    found = attempts.with_outcome(rows("page_number int, html string, status int, error string", *data))
    assert collected(found.select("page_number", "state", "error")) == [
        (1, "done", None), (2, "failed", "HTTP status 503"), (3, "refused", "HTTP status 404"), (4, "failed", "no answer"),
        (5, "failed", "timed out"), (6, "done", None)]


def test_one_attempt_per_page_and_load(spark):
    data = [(1, 1, 7, "a", None), (1, 1, 7, "b", "<p>"), (1, 1, None, "x", None), (1, 1, None, "y", None), (2, 1, 7, "a", None),
            (None, None, None, None, None)]
    found = attempts.attempts(spark.createDataFrame(data, schemas.PAGES), F.lit(NOON))
    assert sorted((str(r.source_id), str(r.page_number), str(r.url), r.state) for r in found.collect()) == [
        ("1", "7", "b", "done"), ("1", "None", "x", "failed"), ("1", "None", "y", "failed"), ("2", "7", "a", "failed"),
        ("None", "None", "None", "failed")]
    empty = attempts.attempts(spark.createDataFrame([], schemas.PAGES), F.lit(NOON))
    assert attempts.open_failures(empty.withColumn("seq", F.lit(1)), "seq").collect() == []


def tried(spark, *states, every=1):
    """Attempts at page 2, a minute apart."""
    data = [(1, 1, 2, "u2", s, "e" if s == "failed" else None, NOON + timedelta(minutes=i * every), i) for i, s in enumerate(states)]
    return spark.createDataFrame(data, schemas.PAGE_ATTEMPTS.simpleString()[7:-1].replace(":", " ") + ", seq bigint")


def test_tries_waits_and_giving_up(spark):
    first = attempts.open_failures(tried(spark, "failed"), "seq")
    assert numbers(attempts.due(first, F.lit(NOON))) == []
    assert numbers(attempts.due(first, F.lit(NOON + timedelta(minutes=1)))) == [2]
    row = attempts.open_failures(tried(spark, "failed", "done", "failed", "failed", "failed"), "seq").first()
    assert (row.tries, row.error, row.url) == (3, "e", "u2")  # what came before a success does not count
    assert row.next_try - row.last_try == timedelta(minutes=4)
    for end in ("done", "refused"):
        assert attempts.open_failures(tried(spark, "failed", "failed", end), "seq").collect() == []
    row = attempts.open_failures(tried(spark, *["failed"] * 6), "seq").first()
    assert row.tries == 6 and row.next_try is None


def test_a_failed_page_is_listed_until_it_succeeds(job):
    load(job, page(1, "A"), page(2, status=503), page(3, status=404), page(4, "D"))
    wh = job.warehouse
    assert collected(wh.read("raw_data").where("error is not null").select("url", "error", "processing_status")) == [
        ("u2", "HTTP status 503", "failed"), ("u3", "HTTP status 404", "failed")]
    assert [r.name for r in wh.read("cleaned_data").orderBy("name").collect()] == ["A", "D"]
    assert numbers(jobs.retry_pages(job, "dir", NOON + timedelta(minutes=1))) == [2]
    assert numbers(jobs.retry_pages(job, "another", NOON + timedelta(days=1))) == []
    load(job, page(2, "B"), minutes=3)
    assert jobs.open_pages(job, "dir").collect() == []


def test_a_run_goes_on_where_the_last_one_broke_off(job):
    spark = job.warehouse.spark
    pages = [page(1, "A"), page(2, status=503), page(3, "C"), page(4, "D"), page(5, "E"), page(6, "F")]
    broken = spark.createDataFrame(pages, PAGES).withColumn(
        "html", F.when(F.col("page_number") == 5, F.raise_error(F.lit("torn page")).cast("string")).otherwise(F.col("html")))
    with pytest.raises(Exception, match="torn page"):
        jobs.run_ingest(job, broken, "dir", "u", pages_per_batch=2, at=NOON)
    wh = job.warehouse
    assert [r.name for r in wh.read("cleaned_data").orderBy("name").collect()] == ["A", "C", "D"]
    later = [page(1, "A again"), page(2, "B"), page(3, "C again"), page(4, "D again"), page(5, "E"), page(6, "F")]
    run = load(job, *later, minutes=5, resume=True, pages_per_batch=4)
    assert [r.name for r in wh.read("cleaned_data").orderBy("name").collect()] == ["A", "B", "C", "D", "E", "F"]
    assert [(r.id, r.status) for r in wh.runs().orderBy("id").collect()] == [(1, "running"), (run, "completed")]
    one = wh.spark.createDataFrame([page(1, "A again")], PAGES)  # a completed run leaves nothing to go on with
    assert numbers(jobs.to_do(job, one, "dir", NOON)) == [1]


def test_listed_failures_and_the_command_line(job, tmp_path, capsys):
    lines = tmp_path / "failed.txt"
    lines.write_text("Page 4: https://x.de/T-Seite-4.html\nPage 1: https://x.de/T-Seite-200.html\nPage 4: https://x.de/T-Seite-4.html\n")
    root = job.warehouse.root
    cli.main([root, "retry", "--source", "dir", "--url", "https://x.de", "--note", str(lines), "--all"])
    assert capsys.readouterr().out == "Page None: https://x.de/T-Seite-200.html\nPage 4: https://x.de/T-Seite-4.html\n"
    cli.main([root, "retry", "--source", "dir"])
    assert capsys.readouterr().out == ""  # the first wait is not over
