"""Pages arrive, entries are extracted, compared with history and appended.

`load_batch` is the whole path for one set of pages, in batch or inside ``foreachBatch``.
Items are staged once in the shared folder, because several plans read them and extraction
is the expensive step; after that, every step reads tables other steps have written, so
a lost executor costs a task, not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf import schemas, session
from ledgerleaf.operators import attempts as A, dedup, extract, ingest as I, ledger
from ledgerleaf.operators.joins import join_reduced
from ledgerleaf.operators.validate import ValidationRules
from ledgerleaf.sources.warehouse import Warehouse
from ledgerleaf.streaming import progress


@dataclass(frozen=True)
class IngestJob:
    warehouse: Warehouse
    rules: extract.EntryRules = extract.LISTING
    validation: ValidationRules | None = None
    #: Reduce the history to the batch's hashes once: right for batches much smaller than it.
    probe_history: bool = True
    #: Leave out the pages behind the first empty one of their source and run, whichever batch that was in.
    stop_at_empty: bool = False
    #: Called with the number of items of all batches whenever a batch takes it past a multiple of the step.
    report: Callable[[int], None] = progress.log_items
    report_every: int = 100
    #: Counts only where the session names no shared folder.
    shared_fallback: str | None = None

    def shared(self, name: str) -> str:
        """A shared folder of this warehouse alone."""
        own = hashlib.sha256(self.warehouse.root.rstrip("/").encode()).hexdigest()[:16]
        return f"{session.shared_dir(self.warehouse.spark, self.shared_fallback)}/{name}/{own}"

    def staging(self, batch_id: int) -> str:
        return f"{self.shared('staged_items')}/batch_id={batch_id}"


def load_batch(job: IngestJob, pages: DataFrame, batch_id: int, at: datetime | None = None) -> None:
    """Ingest pages as batch ``batch_id``; a finished batch is left as it is.

    Pages that were not fetched (`attempts.with_outcome`) become failed raw rows; the attempts at all
    pages are noted with the batch.
    """
    if not job.warehouse.batch("batches", batch_id).isEmpty():
        return
    pages = _whole_pages(pages)
    fetched = A.with_outcome(pages)
    items = extract.listing_items(fetched.where(F.col("state") == A.DONE), job.rules)
    missing = fetched.where(F.col("state") != A.DONE).select(
        "source_id", "run_id", "page_number", "url", F.col("error").alias("page_error"))
    items = items.withColumn("page_error", F.lit(None).cast("string")).unionByName(missing, allowMissingColumns=True)
    load_items(job, items, batch_id, at, pages)


def load_items(job: IngestJob, items: DataFrame, batch_id: int, at: datetime | None = None,
               pages: DataFrame | None = None) -> None:
    """Ingest items as batch ``batch_id``; readers see it when it is whole.

    Rows with a text in ``page_error``, where items have that column, stand for pages that could
    not be read: each becomes a failed raw row, and the other pages go on.  With ``pages``, those
    the items were read from, the attempts at them are noted, and with ``stop_at_empty`` a listing
    ends at its first empty page (`dedup.listing_stops`): items behind it are left out, in this
    batch and in later ones.  What was stored before the empty page arrived stays.
    """
    wh, now = job.warehouse, F.lit(at or ledger.utc_now())
    wh.start_batch(batch_id)
    if "page_error" not in items.columns:
        items = items.withColumn("page_error", F.lit(None).cast("string"))
    numbered = I.with_ids(items, name="item_id")
    watched, watch = progress.observed(numbered, f"batch {batch_id}", "page_error is null")
    read = _staged(watched, job.staging(batch_id))
    items_seen = watch.get["rows"]
    failed = read.where(F.col("page_error").isNotNull()).withColumn("error", F.col("page_error"))
    staged = read.where(F.col("page_error").isNull()).drop("page_error")

    notes = [] if pages is None else [wh.write("page_attempts", A.attempts(pages, now), batch_id)]
    if pages is not None and job.stop_at_empty:
        known = wh.others("page_stops", batch_id)
        new = wh.write("page_stops", dedup.listing_stops(pages, read, known), batch_id)
        staged = dedup.up_to_stop(staged, known.unionByName(wh.rows(new)))
        notes, items_seen = [*notes, new], staged.count()

    last_raw, last_cleaned = wh.last_id("raw_data"), wh.last_id("cleaned_data")
    history = wh.others("raw_data", batch_id).select("hash")
    if job.probe_history:
        history = _seen(job, staged, history, batch_id)
    decided = _staged(
        I.decisions(staged, history, sources=wh.read("data_sources"), runs=wh.read("run_changes")),
        f"{job.shared('decisions')}/batch_id={batch_id}",
    )
    done = I.fetched(staged, decided, "item_id", now)
    raw_rows = done.raw.unionByName(I.failure_rows(failed, now))
    raw = wh.write("raw_data", I.with_ids(raw_rows, last_raw), batch_id)
    rejected = wh.write("rejected_items", done.rejects, batch_id)
    cleaned_rows = I.cleaned_rows(wh.rows(raw), job.validation, now, wh.read("data_sources"))
    cleaned = wh.write("cleaned_data", I.with_ids(cleaned_rows, last_cleaned), batch_id)
    counts = ledger.run_counts(staged, wh.rows(raw)).where("id is not null")
    per_run = wh.write("run_progress", counts, batch_id)
    row = wh.spark.range(1).select(
        F.lit(batch_id).alias("seq"),
        F.lit(items_seen).alias("items_seen"),
        F.lit(raw.rows).alias("raw_rows"),
        F.lit(cleaned.rows).alias("cleaned_rows"),
        F.lit(rejected.rows).alias("rejected_rows"),
        F.lit(raw.max_id or last_raw).alias("max_raw_id"),
        F.lit(cleaned.max_id or last_cleaned).alias("max_cleaned_id"),
        now.alias("finished_at"),
    )
    earlier = wh.read("batches").agg(F.sum("items_seen")).first()[0] or 0
    wh.commit(raw, rejected, cleaned, per_run, *notes, wh.write("batches", row, batch_id))
    progress.report_steps(earlier, items_seen, job.report_every, job.report)
    _staged(numbered.limit(0), job.staging(batch_id))  # free the space


def _whole_pages(pages: DataFrame) -> DataFrame:
    """Pages with all columns of a page; those they lack are NULL."""
    kept = [*schemas.PAGES.fields, *(f for f in schemas.FETCHED_PAGES.fields[len(schemas.PAGES):] if f.name in pages.columns)]
    return pages.select(*[
        (F.col(f.name) if f.name in pages.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kept
    ])


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _seen(job: IngestJob, staged: DataFrame, history: DataFrame, batch_id: int) -> DataFrame:
    """The batch's hashes that the history holds, stored.

    The batch's distinct hashes are stored first, so that the look-up is planned on their true
    size: while that is below the broadcast threshold the history is only scanned, once for
    all that asks for it, and does not move.
    """
    batch = staged.select("hash").where(F.col("hash").isNotNull()).distinct()
    own = _staged(batch, f"{job.shared('batch_hashes')}/batch_id={batch_id}")
    hits = join_reduced(history, own, "hash", "left_semi").distinct()
    return _staged(hits, f"{job.shared('seen_hashes')}/batch_id={batch_id}")


def start_ingest(job: IngestJob, pages: DataFrame, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Run `load_batch` for every micro-batch of a page stream.

    The checkpoint names the stream as a writer, so that a restart replays the unfinished
    micro-batch under its old id, and other loads before or between its runs have ids of their
    own.  No other writer may load batches while it runs.  ``trigger`` is passed on, e.g.
    ``availableNow=True``.
    """
    folder = (checkpoint or job.shared("ingest_stream")).rstrip("/")
    writer = pages.writeStream.option("checkpointLocation", folder)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(
        lambda batch, number: load_batch(job, batch, job.warehouse.batch_id(f"stream {folder}", number))
    ).start()
