"""Declared table schemas.  Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOL, TIME = T.BooleanType(), T.TimestampType()


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


ADDRESS = _struct(street=TEXT, city=TEXT)
CONTACT = _struct(phone=TEXT, hours=TEXT)
DETAILS = _struct(page_number=INT, subtitle=TEXT, raw_html=TEXT)
RAW_CONTENT = _struct(
    name=TEXT, subtitle=TEXT, category=TEXT, address=ADDRESS, phone=TEXT, opening_hours=TEXT,
    page_number=INT, html=TEXT,
)
FIELD_ERRORS = T.ArrayType(_struct(field=TEXT, code=TEXT))
RUN_ERROR = _struct(timestamp=TEXT, error=TEXT)
RUN_ERRORS = T.ArrayType(RUN_ERROR)

PAGES = _struct(source_id=BIGINT, run_id=BIGINT, page_number=INT, url=TEXT, html=TEXT)
#: Pages with how their fetch ended; both columns are NULL for pages that came.
FETCHED_PAGES = T.StructType([*PAGES.fields, *_struct(status=INT, error=TEXT).fields])

DATA_SOURCES = _struct(
    required=("name", "url"),
    id=BIGINT, name=TEXT, url=TEXT, description=TEXT, config=TEXT, is_active=BOOL,
    created_at=TIME, updated_at=TIME,
)
SCRAPING_RUNS = _struct(
    id=BIGINT, source_id=BIGINT, start_time=TIME, end_time=TIME, status=TEXT, items_processed=BIGINT,
    errors=RUN_ERRORS, stats=TEXT, config_snapshot=TEXT,
)
RAW_DATA = _struct(
    id=BIGINT, source_id=BIGINT, run_id=BIGINT, url=TEXT, raw_content=RAW_CONTENT, raw_json=TEXT,
    error=TEXT, hash=TEXT, scraped_at=TIME, processing_status=TEXT,
)
CLEANED_DATA = _struct(
    id=BIGINT, raw_data_id=BIGINT, source_id=BIGINT, name=TEXT, category=TEXT, address=ADDRESS,
    contact=CONTACT, data_json=DETAILS, cleaned_at=TIME, validation_status=TEXT,
    validation_errors=FIELD_ERRORS,
)
REJECTED_ITEMS = _struct(
    source_id=BIGINT, run_id=BIGINT, url=TEXT, raw_content=RAW_CONTENT, raw_json=TEXT, hash=TEXT,
    reason=TEXT, rejected_at=TIME,
)
ENRICHED_DATA = _struct(
    id=BIGINT, cleaned_data_id=BIGINT, enrichment_type=TEXT, data=TEXT, source=TEXT, enriched_at=TIME,
    confidence_score=DOUBLE,
)
MASTER_RECORDS = _struct(
    id=BIGINT, external_id=TEXT, name=TEXT, type=TEXT, status=TEXT, primary_data=TEXT, address=ADDRESS,
    contact=CONTACT, data_json=TEXT, sources=T.ArrayType(BIGINT), created_at=TIME, updated_at=TIME,
    confidence_score=DOUBLE,
)
#: Page-per-row tables older tools wrote; the quality report still reads this shape.
LISTING_PAGES = _struct(
    required=("url",),
    id=BIGINT, url=TEXT, title=TEXT, content=TEXT, metadata=TEXT, created_at=TIME,
)
WEBSITE_DATA = _struct(
    required=("url",),
    id=BIGINT, url=TEXT, title=TEXT, content=TEXT, metadata=TEXT, created_at=TIME, updated_at=TIME,
)

#: One row per ledger change (open, error, close) and one per run and batch with what the
#: batch added; `run_state` folds both into SCRAPING_RUNS rows.
RUN_CHANGES = _struct(
    id=BIGINT, seq=BIGINT, source_id=BIGINT, start_time=TIME, end_time=TIME, status=TEXT,
    error=RUN_ERROR, config_snapshot=TEXT,
)
RUN_PROGRESS = _struct(id=BIGINT, items_seen=BIGINT, items_new=BIGINT)
#: First empty pages of listings, as batches meet them; the least one of a listing counts.
PAGE_STOPS = _struct(source_id=BIGINT, run_id=BIGINT, page_number=INT)
#: One row per page and batch: how the attempt at the page ended (done, failed, refused).
PAGE_ATTEMPTS = _struct(
    source_id=BIGINT, run_id=BIGINT, page_number=INT, url=TEXT, state=TEXT, error=TEXT, attempted_at=TIME,
)

#: One row per batch, written first: who loads it, and its number among that writer's batches.
BATCH_STARTS = _struct(seq=BIGINT, writer=TEXT, number=BIGINT, started_at=TIME)
#: One row per finished batch, visible with its rows.
BATCHES = _struct(
    seq=BIGINT, items_seen=BIGINT, raw_rows=BIGINT, cleaned_rows=BIGINT, rejected_rows=BIGINT,
    max_raw_id=BIGINT, max_cleaned_id=BIGINT, finished_at=TIME,
)

TABLES = {
    "data_sources": DATA_SOURCES,
    "run_changes": RUN_CHANGES,
    "run_progress": RUN_PROGRESS,
    "page_stops": PAGE_STOPS,
    "page_attempts": PAGE_ATTEMPTS,
    "batch_starts": BATCH_STARTS,
    "batches": BATCHES,
    "raw_data": RAW_DATA,
    "cleaned_data": CLEANED_DATA,
    "rejected_items": REJECTED_ITEMS,
    "enriched_data": ENRICHED_DATA,
    "master_records": MASTER_RECORDS,
    "listing_pages": LISTING_PAGES,
    "website_data": WEBSITE_DATA,
}

#: Tables that batches are loaded into; all of a batch becomes visible in one step.
LOADED_TABLES = ("run_progress", "page_stops", "page_attempts", "raw_data", "cleaned_data", "rejected_items")

#: Tables whose rows refer to rows of a table; the loaded tables need the record of their batches.
REFERRED_BY = {
    "data_sources": ("run_changes", "page_stops", "page_attempts", "raw_data", "cleaned_data", "rejected_items"),
    "run_changes": ("run_progress", "page_stops", "page_attempts", "raw_data", "rejected_items"),
    "raw_data": ("cleaned_data",),
    "cleaned_data": ("enriched_data",),
    "batches": ("batch_starts", *LOADED_TABLES),
    "batch_starts": ("batches", *LOADED_TABLES),
}

#: Column lengths of the relational schema.  A longer value is refused on writing.
WIDTHS = {
    "data_sources": {"name": 255},
    "run_changes": {"status": 50},
    "raw_data": {"processing_status": 50},
    "cleaned_data": {"name": 255, "category": 255, "validation_status": 50},
    "enriched_data": {"enrichment_type": 255, "source": 255},
    "master_records": {"external_id": 255, "name": 255, "type": 255, "status": 50},
}

#: Lengths that are looked at before, item by item: longer values reject the item.
LENGTH_LIMITS = {c: WIDTHS["cleaned_data"][c] for c in ("name", "category")}

#: Status domains as stored.
PROCESSING_STATUSES = ("pending", "processed", "failed")
VALIDATION_STATUSES = ("valid", "partial", "invalid")
RUN_STATUSES = ("running", "completed")

#: Values filled in when an inserted row leaves the column NULL, and the columns that
#: then take the batch's clock value.
DEFAULTS = {
    "data_sources": {"is_active": True},
    "raw_data": {"processing_status": "pending"},
    "scraping_runs": {"items_processed": 0},
}
TIMESTAMP_DEFAULTS = {
    "data_sources": ("created_at", "updated_at"),
    "scraping_runs": ("start_time",),
    "raw_data": ("scraped_at",),
    "cleaned_data": ("cleaned_at",),
    "enriched_data": ("enriched_at",),
    "master_records": ("created_at", "updated_at"),
    "listing_pages": ("created_at",),
    "website_data": ("created_at", "updated_at"),
}
