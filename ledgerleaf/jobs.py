"""Whole runs: open the ledger entry, ingest, close it; enrich and consolidate what is stored."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf import schemas
from ledgerleaf.operators import attempts as A, consolidate, enrich, ingest as I, joins, ledger, validate
from ledgerleaf.sources import manifest
from ledgerleaf.sources.pages import resume_after
from ledgerleaf.streaming.ingest import IngestJob, load_batch


def source_id(job: IngestJob, name: str, url: str, **details) -> int:
    """Id of the source of that name; it is added when there is none."""
    wh = job.warehouse
    known = wh.read("data_sources")
    found = known.where(F.col("name") == name).select("id").orderBy("id").first()
    if found is None:
        row = {f.name: details.get(f.name) for f in schemas.DATA_SOURCES.fields if f.name in details}
        one = wh.spark.createDataFrame([{"name": name, "url": url, **row}],
                                       "name string, url string" + "".join(f", {c} string" for c in row))
        wh.put("data_sources", ledger.new_sources(known, one, after=wh.last_id("data_sources")), wh.next_batch("data_sources"))
        return source_id(job, name, url)
    return found[0]


def change_sources(job: IngestJob, changes: DataFrame) -> None:
    """Change stored sources by name, e.g. their configuration, and add those that are new."""
    job.warehouse.create_tables()
    job.warehouse.upsert("data_sources", changes, "name")


def retry_pages(job: IngestJob, name: str, at: datetime | None = None) -> DataFrame:
    """The pages of a source that are to be tried again by now (`attempts.open_failures`)."""
    return A.due(open_pages(job, name), F.lit(at or ledger.utc_now()))


def open_pages(job: IngestJob, name: str) -> DataFrame:
    """The pages of a source whose last attempts failed, those that were given up included."""
    wh = job.warehouse
    ids = wh.read("data_sources").where(F.col("name") == name).select("id")
    tried = joins.with_matching_ids(wh.read("page_attempts"), "source_id", ids)
    return A.open_failures(tried, manifest.BATCH)


def note_failures(job: IngestJob, failed: DataFrame, name: str, url: str) -> None:
    """Note pages (page, url) that another tool could not fetch, e.g. `pages.failed_urls`, as failed attempts.

    A page whose number differs from the one in its URL is known by the URL alone.
    """
    wh = job.warehouse
    wh.create_tables()
    source = source_id(job, name, url)
    number = F.when(~F.col("mismatch"), F.col("page")) if "mismatch" in failed.columns else F.col("page")
    rows = failed.select(F.lit(source).cast("bigint").alias("source_id"), F.lit(None).cast("bigint").alias("run_id"),
                         number.alias("page_number"), "url", F.lit(None).cast("string").alias("html"),
                         F.lit("listed as failed").alias("error"))
    batch = wh.batch_id(f"failures {uuid.uuid4().hex}", 0)
    wh.put("page_attempts", A.attempts(rows, F.lit(ledger.utc_now())), batch)


def to_do(job: IngestJob, pages: DataFrame, name: str, at: datetime | None = None) -> DataFrame:
    """Pages a resumed run reads: those behind the point where the source's last run broke off, and those due again.

    A last run that was completed leaves no such point: all pages are read.
    """
    wh = job.warehouse
    source = wh.read("data_sources").where(F.col("name") == name).agg(F.min("id")).first()[0]
    last = None if source is None else wh.runs().where(F.col("source_id") == source).orderBy(F.desc("id")).first()
    if last is None or last["status"] == "completed":
        return pages
    point = wh.spark.createDataFrame([(A.reached(wh.read("page_attempts"), last["id"]),)], "last_page int")
    numbered = pages.where(F.col("page_number").isNotNull())
    again = retry_pages(job, name, at).where(F.col("page_number").isNotNull()).select(F.col("page_number").cast("int"))
    new = resume_after(numbered, point)
    due = joins.join_reduced(numbered, again.distinct(), "page_number", "left_semi")
    earlier = due.where(F.col("page_number") <= point.first()[0])
    return new.unionByName(earlier).unionByName(pages.where(F.col("page_number").isNull()))


def _portions(pages: DataFrame, per_batch: int | None) -> Iterator[DataFrame]:
    """Pages in the order of their numbers, ``per_batch`` numbers at a time; those without a number come first."""
    if per_batch is None:
        yield pages
        return
    low, high = pages.agg(F.min("page_number"), F.max("page_number")).first()
    if low is None:
        yield pages
        return
    for start in range(low, high + 1, per_batch):
        here = F.col("page_number").between(start, start + per_batch - 1)
        yield pages.where(here | F.col("page_number").isNull() if start == low else here)


def run_ingest(job: IngestJob, pages: DataFrame, name: str, url: str, config: dict | None = None,
               resume: bool = False, pages_per_batch: int | None = None, at: datetime | None = None) -> int:
    """Ingest a page frame (page_number, html) as one run of a source; returns the run id.

    A failure is noted on the run, which stays open, and raised again.  With ``pages_per_batch`` the
    run's finished batches stay, and a later run with ``resume`` goes on behind them and reads the pages
    that are due again (`to_do`).  One driver writes the ledger at a time.
    """
    wh = job.warehouse
    wh.create_tables()
    source = source_id(job, name, url)
    if resume:
        pages = to_do(job, pages, name, at)
    run = wh.last_id("run_changes") + 1

    def note(change) -> None:
        seq = wh.next_batch("run_changes")
        wh.put("run_changes", change(seq), seq)

    note(lambda seq: ledger.open_run(wh.spark, run, source, config, seq=seq))
    tagged = pages.withColumns({"source_id": F.lit(source), "run_id": F.lit(run)})
    try:
        writer = f"run {run} {uuid.uuid4().hex}"  # run ids restart, batches do not
        for number, portion in enumerate(_portions(tagged, pages_per_batch)):
            load_batch(job, portion, wh.batch_id(writer, number), at)
    except Exception as error:
        message = str(error)
        note(lambda seq: ledger.record_error(wh.spark, run, seq, message))
        raise
    note(lambda seq: ledger.close_run(wh.spark, run, seq))
    return run


def enrich_records(job: IngestJob, reference: DataFrame, key: Column, reference_key: str,
                   take: Sequence[str], kind: str, source: str) -> None:
    """Look all cleaned records up in a reference table; their rows of that kind and source are replaced.

    ``key`` is a column of the standardised records, e.g. ``F.col("address.city")``.
    """
    wh = job.warehouse
    wh.create_tables()
    stored = wh.read("enriched_data")
    mine = (F.col("enrichment_type") == kind) & (F.col("source") == source)
    known = stored.where(mine).select("batch_id").first()
    batch = wh.next_batch("enriched_data") if known is None else known[0]
    last = stored.where(F.col("batch_id") != batch).agg(F.max("id")).first()[0] or 0
    records = validate.standardize(wh.read("cleaned_data"))
    rows = enrich.enriched_rows(records, reference, key, reference_key, take, kind, source)
    wh.put("enriched_data", I.with_ids(rows, last), batch)


def rebuild_masters(job: IngestJob) -> None:
    """Standardise and consolidate all cleaned records into master_records, as its only batch.

    The confidence of records that were looked up decides which fields a master row takes.
    """
    wh = job.warehouse
    scores = wh.read("enriched_data").select("cleaned_data_id", "confidence_score")
    masters = consolidate.master_records(validate.standardize(wh.read("cleaned_data")), scores)
    wh.put("master_records", I.with_ids(masters), 0)
