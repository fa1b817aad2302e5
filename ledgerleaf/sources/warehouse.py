"""The tables as Parquet files that a versioned list names.

Rows are written to files of their own and become visible when a version of the list names them
(:mod:`ledgerleaf.sources.manifest`); all tables of a batch appear in one version, so readers
see whole batches only.  ``batch_id`` is a column of the files: a file knows the batches
it holds, small files of many batches are merged, and readers of one batch open only what holds it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerleaf import schemas
from ledgerleaf.functions import text as X
from ledgerleaf.operators import joins
from ledgerleaf.operators.ingest import with_ids
from ledgerleaf.operators.joins import fill_defaults, join_reduced
from ledgerleaf.operators.ledger import run_state, utc_now
from ledgerleaf.sources import manifest
from ledgerleaf.sources.manifest import File

PART = T.StructField(manifest.BATCH, T.LongType())


@dataclass(frozen=True)
class Written:
    """Rows of one table that are stored and not yet visible."""

    table: str
    files: tuple[File, ...]
    batch_id: int | None

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files)

    @property
    def max_id(self) -> int | None:
        return max((f.max_id for f in self.files if f.max_id is not None), default=None)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    @property
    def place(self) -> str:
        return self.root.rstrip("/")

    def schema(self, table: str) -> T.StructType:
        return T.StructType([*schemas.TABLES[table].fields, PART])

    # ---- versions ------------------------------------------------------------------------

    def version(self) -> int | None:
        """Number of the newest version."""
        return manifest.newest(self.spark, self.place)

    def files(self, table: str | None = None, version: int | None = None) -> list[File]:
        """Live files of a table or of all, in the newest version or an earlier one that was kept."""
        found = manifest.live(self.spark, self.place, self.version() if version is None else version)
        return [f for f in found if table is None or f.table == table]

    def commit(self, *written: Written, emptied: Iterable[str] = (), merged: Iterable[File] = ()) -> int:
        """Make written rows visible, all at once, and return the version's number.

        Rows of a batch take the place of what the table held of that batch.  ``emptied`` tables
        lose what they had; ``merged`` files, which must still be live, give way to the written ones.
        """
        last = self.version()
        before = manifest.live(self.spark, self.place, last)
        merged, emptied = set(merged), set(emptied)
        if not merged <= set(before):
            raise manifest.Conflict("files that were to be replaced are no longer live")
        kept = [f for f in before if f not in merged and f.table not in emptied]
        for one in written:
            if one.batch_id is None:
                continue
            mixed = [f for f in kept if f.table == one.table and f.may_hold(one.batch_id) and not f.holds_only(one.batch_id)]
            kept = [f for f in kept if f not in mixed and not (f.table == one.table and f.holds_only(one.batch_id))]
            if mixed:  # merged files that hold other batches too are written again without this one
                rest = self._open(one.table, mixed).where(F.col(PART.name) != one.batch_id)
                kept += self._store(one.table, rest)
        number = 0 if last is None else last + 1
        manifest.publish(self.spark, self.place, number, kept + [f for one in written for f in one.files])
        return number

    def _store(self, table: str, rows: DataFrame) -> list[File]:
        folder = f"{table}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.place}/{folder}")
        return manifest.described(self.spark, self.place, table, folder, self.schema(table))

    def _open(self, table: str, files: Iterable[File]) -> DataFrame:
        return manifest.opened(self.spark, self.place, files, self.schema(table))

    # ---- writing -------------------------------------------------------------------------

    def create_tables(self) -> None:
        """Every table that does not exist yet, empty."""
        if self.version() is None:
            self.commit()

    def reset(self) -> None:
        """Every table empty; safe to repeat."""
        self.commit(emptied=schemas.TABLES)

    def write(self, table: str, df: DataFrame, batch_id: int) -> Written:
        """Store one batch of a table without showing it.

        Rows are fitted to the declared schema: missing columns are NULL, others fail, and so does
        a text that is longer than its column.
        """
        fitted = self._fitted(table, df)
        files = self._store(table, fitted.withColumn(PART.name, F.lit(batch_id).cast(PART.dataType)))
        return Written(table, tuple(files), batch_id)

    def _fitted(self, table: str, df: DataFrame, *keep: str) -> DataFrame:
        """The declared columns of a table, cast and checked, and those to keep as they are."""
        declared, widths = schemas.TABLES[table], schemas.WIDTHS.get(table, {})

        def fits(column: Column, name: str) -> Column:
            if name not in widths:
                return column
            refused = F.raise_error(F.lit(f"{table}.{name} is longer than {widths[name]} characters"))
            return F.when(X.too_long(column, widths[name]), refused.cast("string")).otherwise(column)

        unknown = set(df.columns) - set(declared.fieldNames()) - set(keep)
        if unknown:
            raise ValueError(f"{table} has no columns {sorted(unknown)}")
        return df.select(*[
            fits((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType), f.name).alias(f.name)
            for f in declared.fields
        ], *keep)

    def upsert(self, table: str, changes: DataFrame, key: str = "id", at: datetime | None = None) -> int:
        """Lay changes over the rows that have their key, add the others, and return the version's number.

        ``changes`` holds one row per key, never a NULL key, and gives the same rows whenever it is read.  NULL
        keeps the old value.  ``updated_at`` becomes the time of the change on changed rows and
        on no others.  Only files that hold a changed key are written again; the keys alone are
        read to find them, and what comes to the driver is their names, which the list of files
        holds anyway.  Added rows take the table's defaults, a batch of their own, and where the key is
        not ``id``, an id.
        """
        now = F.lit(at or utc_now())
        live = self.files(table)
        stored, keys = self._open(table, live), changes.select(key)
        file = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1).alias("_file")
        hit = set()
        if live:
            found = join_reduced(stored.select(key, file), keys.distinct(), key, "left_semi")
            hit = {f"{table}/{r['_file']}" for r in found.select("_file").distinct().collect()}
        touched = [f for f in live if f.path in hit]
        old = self._open(table, touched)
        mine = join_reduced(changes, old.select(key).distinct(), key, "left_semi")
        added = join_reduced(changes, old.select(key).distinct(), key, "left_anti")
        added = fill_defaults(added, schemas.DEFAULTS.get(table, {}), now, schemas.TIMESTAMP_DEFAULTS.get(table, ()))
        if key != "id" and "id" in schemas.TABLES[table].fieldNames():
            added = with_ids(added.drop("id"), self.last_id(table))
        new = self.write(table, added, self.next_batch(table))
        files = [f for f in new.files if f.rows]
        if touched:
            changed = joins.upsert(old, mine, key, touch=now)
            rows = self._fitted(table, changed.withColumnRenamed(PART.name, "_batch"), "_batch")
            files += self._store(table, rows.withColumnRenamed("_batch", PART.name))
        return self.commit(Written(table, tuple(files), None), merged=touched)

    def put(self, table: str, df: DataFrame, batch_id: int) -> Written:
        """Write one batch of a table, in place of whatever the table holds of that batch."""
        written = self.write(table, df, batch_id)
        self.commit(written)
        return written

    def truncate(self, *tables: str, cascade: bool = False) -> dict[str, dict[str, int]]:
        """Empty tables in one step and report each one's counts; later ids start from 1 again.

        Tables whose rows refer to an emptied one must be empty, among ``tables``, or taken along
        by ``cascade``; they are reported first.  The tables that say which batches were loaded go
        only together with all that was loaded.
        """
        live = self.files()
        chosen = set(tables)
        waiting = list(tables)
        while waiting:
            for child in schemas.REFERRED_BY.get(waiting.pop(), ()):
                if child not in chosen and (cascade or any(f.table == child for f in live)):
                    if not cascade:
                        raise ValueError(f"{child} has rows that refer to {', '.join(tables)}: truncate it too, or cascade")
                    chosen.add(child)
                    waiting.append(child)
        self.commit(emptied=chosen)
        left = self.files()
        report = {}
        for table in sorted(chosen, key=list(schemas.TABLES).index, reverse=True):
            before, after = (sum(f.rows for f in files if f.table == table) for files in (live, left))
            report[table] = {"before": before, "after": after, "deleted": before - after}
        return report

    def compact(self, *tables: str, target_bytes: int = 512 << 20) -> dict[str, tuple[int, int]]:
        """Merge files under half the target size; returns each table's number of files before and after.

        Rows are dealt by batch and id, so merged files still hold few batches each.  Readers
        keep the files they opened; :meth:`vacuum` deletes those that no kept version names.
        """
        done = {}
        for table in tables or schemas.TABLES:
            live = self.files(table)
            small = [f for f in live if f.bytes < target_bytes // 2]
            parts = math.ceil(sum(f.bytes for f in small) / target_bytes)
            if parts < len(small):
                rows = self._open(table, small)
                within = F.col("id") if "id" in rows.columns else F.xxhash64(*rows.columns)
                files = self._store(table, rows.repartitionByRange(parts, PART.name, within).sortWithinPartitions(PART.name))
                self.commit(Written(table, tuple(files), None), merged=small)
                done[table] = (len(live), len(live) - len(small) + len(files))
            else:
                done[table] = (len(live), len(live))
        return done

    def vacuum(self, keep: int = 10, min_age: float = 24 * 3600) -> int:
        """Delete old versions and the files only they name; returns the number of files."""
        return manifest.sweep(self.spark, self.place, schemas.TABLES, keep, min_age)

    # ---- reading -------------------------------------------------------------------------

    def _select(self, table: str, chosen: Callable[[File], bool], version: int | None = None) -> DataFrame:
        return self._open(table, [f for f in self.files(table, version) if chosen(f)])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The table as it is in the newest version, or as it was in an earlier one."""
        return self._select(table, lambda f: True, version)

    def rows(self, written: Written) -> DataFrame:
        """What was just written, visible or not."""
        return self._open(written.table, written.files)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """The rows of one batch."""
        return self._select(table, lambda f: f.may_hold(batch_id)).where(F.col(PART.name) == batch_id)

    def before(self, table: str, batch_id: int) -> DataFrame:
        return self._select(table, lambda f: f.first_batch < batch_id).where(F.col(PART.name) < batch_id)

    def others(self, table: str, batch_id: int) -> DataFrame:
        """The rows of all batches but this one."""
        return self._select(table, lambda f: not f.holds_only(batch_id)).where(F.col(PART.name) != batch_id)

    def next_batch(self, *tables: str) -> int:
        """The number after the highest batch that any of the tables holds."""
        return max((f.last_batch for f in self.files() if f.table in tables), default=-1) + 1

    def last_id(self, table: str) -> int:
        """Highest id of a table, 0 where it is empty."""
        return max((f.max_id for f in self.files(table) if f.max_id is not None), default=0)

    def batch_id(self, writer: str, number: int) -> int:
        """Id of a writer's batch: the one it had before, or the next that nobody has.

        All loads take their ids from here, so writers that take turns never share one.
        """
        mine = (F.col("writer") == writer) & (F.col("number") == number)
        known = self.read("batch_starts").where(mine).select(PART.name).first()
        if known is not None:
            return known[0]
        new = self.next_batch("batch_starts", "batches", *schemas.LOADED_TABLES)
        self.start_batch(new, writer, number)
        return new

    def start_batch(self, batch_id: int, writer: str | None = None, number: int | None = None) -> None:
        """Note that a batch is about to write; one that was noted before stays as it is."""
        if self.batch("batch_starts", batch_id).isEmpty():
            row = self.spark.range(1).select(
                F.lit(batch_id).alias("seq"), F.lit(writer).alias("writer"), F.lit(number).alias("number"),
                F.current_timestamp().alias("started_at"),
            )
            self.put("batch_starts", row, batch_id)

    def runs(self) -> DataFrame:
        """The run ledger, one current row per run."""
        return run_state(self.read("run_changes"), self.read("run_progress"))

    def register_views(self, prefix: str = "") -> None:
        """Temp views of all tables, and of the folded run ledger, for SQL text."""
        for table in schemas.TABLES:
            self.read(table).createOrReplaceTempView(prefix + table)
        self.runs().createOrReplaceTempView(prefix + "scraping_runs")
