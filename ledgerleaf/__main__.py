"""Command line: ``python -m ledgerleaf WAREHOUSE COMMAND ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from ledgerleaf import jobs, schemas
from ledgerleaf.plans import quality, reports
from ledgerleaf.session import get_session
from ledgerleaf.sources import export, pages
from ledgerleaf.sources.warehouse import Warehouse
from ledgerleaf.streaming.ingest import IngestJob


def report(wh: Warehouse, name: str, source: str, status: str, term: str):
    sources, raw, masters = wh.read("data_sources"), wh.read("raw_data"), wh.read("master_records")
    cleaned = wh.read("cleaned_data")
    return {
        "overview": lambda: reports.overview(sources, raw, masters),
        "runs": lambda: reports.recent_runs(wh.runs(), sources),
        "sources": lambda: reports.source_stats(sources, raw),
        "raw": lambda: reports.raw_explorer(raw, sources, source, status),
        "cleaned": lambda: reports.cleaned_explorer(cleaned, sources, source, status),
        "masters": lambda: reports.search(masters, term),
        "days": lambda: reports.records_per_day(raw),
        "validation": lambda: reports.status_share(cleaned),
        "distribution": lambda: reports.source_counts(sources, raw),
    }[name]()


REPORTS = "overview runs sources raw cleaned masters days validation distribution".split()


def print_rows(frame) -> None:
    """All rows and whole values, tab separated, a partition at a time."""
    print("\t".join(frame.columns))
    for row in frame.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerleaf", description=__doc__)
    parser.add_argument("warehouse", help="folder of the tables")
    todo = parser.add_subparsers(dest="command", required=True)
    todo.add_parser("create", help="create missing tables")
    todo.add_parser("reset", help="empty every table")
    todo.add_parser("consolidate", help="rebuild the master records")
    one = todo.add_parser("enrich", help="look the cleaned records up in a reference table")
    one.add_argument("reference", help="Parquet folder of the reference table")
    one.add_argument("--key", required=True, help="SQL expression over a cleaned record, e.g. address.city")
    one.add_argument("--reference-key", required=True)
    one.add_argument("--take", required=True, help="columns of the reference to keep, comma separated")
    one.add_argument("--kind", required=True, help="enrichment type")
    one.add_argument("--source", required=True, help="name of the reference")
    one = todo.add_parser("truncate", help="empty tables in one step and report the counts")
    one.add_argument("tables", nargs="+", choices=sorted(schemas.TABLES))
    one.add_argument("--cascade", action="store_true", help="also the tables that refer to them")
    one = todo.add_parser("compact", help="merge small files of tables, of all if none is named")
    one.add_argument("tables", nargs="*")
    one.add_argument("--target-mb", type=int, default=512)
    one = todo.add_parser("vacuum", help="delete old versions and the files only they name")
    one.add_argument("--keep", type=int, default=10, help="newest versions to keep")
    one.add_argument("--min-age", type=float, default=24.0, help="hours after which an unnamed file may go")
    one = todo.add_parser("ingest", help="ingest listing pages as one run of a source")
    one.add_argument("pages", help="folder of page files, or of Parquet with --table")
    one.add_argument("--table", action="store_true")
    one.add_argument("--source", required=True)
    one.add_argument("--url", required=True)
    one.add_argument("--resume", action="store_true", help="go on behind an unfinished run, with the pages that are due again")
    one.add_argument("--pages-per-batch", type=int, help="page numbers that are loaded at a time")
    one.add_argument("--shared", help="folder all executors reach, where spark.checkpoint.dir is not set")
    one = todo.add_parser("retry", help="list the pages of a source that are to be tried again, as `Page N: URL`")
    one.add_argument("--source", required=True)
    one.add_argument("--all", action="store_true", help="also those that wait or were given up")
    one.add_argument("--note", help="first note the pages that a file lists so as failed")
    one.add_argument("--url", default="", help="URL of the source, where it is new")
    one = todo.add_parser("report", help="show a report")
    one.add_argument("name", choices=REPORTS)
    one.add_argument("--source", default="")
    one.add_argument("--status", default="All")
    one.add_argument("--term", default="")
    one = todo.add_parser("verify", help="check a table with URL and JSON metadata columns")
    one.add_argument("table", choices=["listing_pages", "website_data"])
    one = todo.add_parser("export", help="write a table as CSV, JSON or Parquet")
    one.add_argument("table", choices=sorted(schemas.TABLES))
    one.add_argument("path")
    one.add_argument("--format", default="csv", choices=export.FORMATS)
    args = parser.parse_args(argv)

    wh = Warehouse(get_session(), args.warehouse)
    if args.command in ("create", "reset"):
        wh.create_tables() if args.command == "create" else wh.reset()
    elif args.command == "consolidate":
        jobs.rebuild_masters(IngestJob(wh))
    elif args.command == "enrich":
        jobs.enrich_records(IngestJob(wh), wh.spark.read.parquet(args.reference), F.expr(args.key),
                            args.reference_key, args.take.split(","), args.kind, args.source)
    elif args.command == "truncate":
        for table, counts in wh.truncate(*args.tables, cascade=args.cascade).items():
            print(table, counts)
    elif args.command == "compact":
        for table, (before, after) in wh.compact(*args.tables, target_bytes=args.target_mb << 20).items():
            print(f"{table}: {before} files, now {after}")
    elif args.command == "vacuum":
        print(wh.vacuum(args.keep, args.min_age * 3600))
    elif args.command == "ingest":
        found = pages.page_table(wh.spark, args.pages, schemas.FETCHED_PAGES) if args.table else pages.page_files(wh.spark, args.pages)
        job = IngestJob(wh, shared_fallback=args.shared)
        print(jobs.run_ingest(job, found, args.source, args.url, resume=args.resume, pages_per_batch=args.pages_per_batch))
    elif args.command == "retry":
        job = IngestJob(wh)
        if args.note:
            jobs.note_failures(job, pages.failed_urls(wh.spark, args.note), args.source, args.url)
        listed = jobs.open_pages(job, args.source) if args.all else jobs.retry_pages(job, args.source)
        for row in listed.orderBy("page_number", "url").toLocalIterator():
            print(f"Page {row.page_number}: {row.url}")
    elif args.command == "report":
        print_rows(report(wh, args.name, args.source, args.status, args.term))
    elif args.command == "verify":
        for name, frame in quality.quality_report(wh.read(args.table)).items():
            print(name)
            print_rows(frame)
    else:
        export.export(wh.read(args.table), args.path, args.format)


if __name__ == "__main__":
    main()
