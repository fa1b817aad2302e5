"""Items to raw, cleaned and rejected rows.

`ingest` is a pure plan.  An item either violates a table rule (it is rejected with a
reason and leaves no hash), repeats known content (it is dropped), or is new.  New items
whose address cannot be read are kept as failed, with an error row beside them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf import schemas
from ledgerleaf.functions import text as X

from .dedup import drop_seen, drop_seen_probing, first_wins, never_null
from .joins import join_reduced
from .validate import ValidationRules, apply_stored_rules

#: Arrival order of items: runs follow one another, a run reads its pages in order.
ARRIVAL = ["run_id", "page_number", "entry_pos", "source_id", "url"]

#: Width of the partition slot in generated ids.
ID_SLOTS = 1 << 24


@dataclass(frozen=True)
class Ingested:
    raw: DataFrame
    rejects: DataFrame


def flag(items: DataFrame, sources: DataFrame | None = None, runs: DataFrame | None = None,
         limits: dict[str, int] | None = None) -> DataFrame:
    """Items with the first rule they violate in ``reason`` (NULL when none).

    Source and run keys may be NULL but not unknown.  A length only counts where a
    cleaned row would be written, i.e. not for items whose address cannot be read.
    """
    limits = schemas.LENGTH_LIMITS if limits is None else limits
    out, checks = items, [(F.col("hash").isNull(), "bad_json")]
    for parent, key, reason in ((sources, "source_id", "unknown_source"), (runs, "run_id", "unknown_run")):
        if parent is not None:
            known = f"_known_{key}"
            ids = parent.select(F.col("id").alias(key)).distinct().withColumn(known, F.lit(True))
            out = join_reduced(out, ids, key, "left")
            checks.append((F.col(key).isNotNull() & F.col(known).isNull(), reason))
    for name, limit in limits.items():
        over = F.col("address_error").isNull() & X.too_long(F.col("raw_content")[name], limit)
        checks.append((over, f"too_long:{name}"))
    reason = F.coalesce(*[F.when(hit, F.lit(name)) for hit, name in checks])
    return out.select(*items.columns, reason.alias("reason"))


def ingest(items: DataFrame, history: DataFrame, sources: DataFrame | None = None,
           runs: DataFrame | None = None, limits: dict[str, int] | None = None,
           now: Column | None = None, probe_history: bool = False,
           item_id: str | None = None) -> Ingested:
    """Raw rows to append (without ids) and rejected items.

    ``history`` has a ``hash`` column; ``probe_history`` is for batches much smaller than it.
    The winners' shuffle on ``hash`` also serves the look-up against the history.

    ``item_id`` names a unique column of items that are stored, i.e. cheap to read twice.
    :func:`decisions` are then taken on hashes and ids alone, and the contents of what is
    stored, markup and all, are fetched by id: without moving them while the decided items
    are few enough to broadcast, in one shuffle on a unique key otherwise.  Without it the
    contents travel with the hashes, one candidate per map task and hash.
    """
    now = F.current_timestamp() if now is None else now
    if item_id is not None:
        return fetched(items, decisions(items, history, sources, runs, limits, item_id), item_id, now)
    unseen = drop_seen_probing if probe_history else drop_seen
    flagged = flag(items, sources, runs, limits)
    sound = flagged.where(F.col("reason").isNull()).drop("reason")
    fresh = unseen(first_wins(sound, "hash", ARRIVAL), history)
    bad = _kept(flagged, history).where(F.col("reason").isNotNull())
    return Ingested(raw_rows(fresh, now), rejected_rows(bad, now))


def decisions(items: DataFrame, history: DataFrame, sources: DataFrame | None = None,
              runs: DataFrame | None = None, limits: dict[str, int] | None = None,
              item_id: str = "item_id") -> DataFrame:
    """(item_id, reason) of the items that are to be stored: rejected ones have a reason, new ones none.

    One pass over hashes, ids and what the rules look at decides on both.  Store it before
    :func:`fetched` reads it twice.
    """
    flagged = flag(items, sources, runs, limits).select("hash", item_id, *ARRIVAL, "reason")
    return _kept(flagged, history, item_id).select(item_id, "reason")


def fetched(items: DataFrame, decided: DataFrame, item_id: str, now: Column) -> Ingested:
    """The rows of decided items, whose contents are fetched by id."""
    new, bad = decided.where(F.col("reason").isNull()), decided.where(F.col("reason").isNotNull())
    fresh = items.join(new.select(item_id), item_id, "left_semi")
    return Ingested(raw_rows(fresh, now), rejected_rows(items.join(bad, item_id), now))


def _kept(flagged: DataFrame, history: DataFrame, item_id: str | None = None) -> DataFrame:
    """Flagged items that are new, and violating ones that repeat nothing stored or accepted before them.

    One aggregate per hash finds the first sound arrival and carries every violating item beside it
    as a row of its own.  The accepted hashes are cut out of that same aggregate, so that
    both sides of the last join share its shuffle, and the items are read once.  For this both
    must need the same of it: the key is never NULL and all else is one struct, lest the optimizer
    push a filter or a narrower projection into one of them.
    """
    own = F.monotonically_increasing_id() if item_id is None else F.col(item_id)
    arrival = never_null(ARRIVAL if item_id is None else [*ARRIVAL, item_id])
    keyed = flagged.select("*", F.coalesce("hash", F.lit("")).alias("_key"), arrival.alias("_arrival"),
                           F.when(F.col("reason").isNotNull(), own).alias("_own"))
    row = F.min_by(F.struct(*flagged.columns, "_arrival"), "_arrival")
    reduced = keyed.groupBy("_key", "_own").agg(row.alias("_row"))
    seen = history.select(F.col("hash").alias("_key")).where(F.col("_key").isNotNull()).distinct()
    accepted = reduced.where(F.col("_row.reason").isNull()).select("_key", F.col("_row._arrival").alias("_first"))
    repeats = F.col("_row.reason").isNotNull() & (F.col("_first") < F.col("_row._arrival"))
    unseen = join_reduced(reduced, seen, "_key", "left_anti")
    return join_reduced(unseen, accepted, "_key", "left_anti", repeats).select("_row.*").drop("_arrival")


def raw_rows(fresh: DataFrame, now: Column) -> DataFrame:
    """One raw row per item and an error row next to each failed one, in one pass."""
    failed = F.col("address_error").isNotNull()
    copies = F.explode(F.when(failed, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    rows = fresh.withColumn("_is_error", copies)
    error = F.col("_is_error")
    return rows.select(
        "source_id",
        "run_id",
        "url",
        F.when(~error, F.col("raw_content")).alias("raw_content"),
        F.when(~error, F.col("raw_json")).alias("raw_json"),
        F.when(error, F.col("address_error")).alias("error"),
        F.when(~error, F.col("hash")).alias("hash"),
        now.alias("scraped_at"),
        F.when(failed, "failed").otherwise("processed").alias("processing_status"),
    )


def rejected_rows(bad: DataFrame, now: Column) -> DataFrame:
    return bad.select(
        "source_id", "run_id", "url", "raw_content", "raw_json", "hash", "reason",
        now.alias("rejected_at"),
    )


def failure_rows(failures: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw error rows for failures outside the item path: (source_id, run_id, url, error)."""
    now = F.current_timestamp() if now is None else now
    return failures.select(
        "source_id", "run_id", "url",
        F.lit(None).cast(schemas.RAW_CONTENT).alias("raw_content"),
        F.lit(None).cast("string").alias("raw_json"),
        "error",
        F.lit(None).cast("string").alias("hash"),
        now.alias("scraped_at"),
        F.lit("failed").alias("processing_status"),
    )


def cleaned_rows(raw: DataFrame, rules: ValidationRules | None = None,
                 now: Column | None = None, sources: DataFrame | None = None) -> DataFrame:
    """Cleaned rows of processed raw rows.

    Read ``raw`` back from the stored table, so that both tables agree on the ids.
    Without ``rules`` every record counts as valid.  The rules that ``sources`` have in their
    configuration are applied before.
    """
    now = F.current_timestamp() if now is None else now
    content = F.col("raw_content")
    done = raw.where((F.col("processing_status") == "processed") & F.col("hash").isNotNull())
    cleaned = done.select(
        F.col("id").alias("raw_data_id"),
        "source_id",
        content["name"].alias("name"),
        content["category"].alias("category"),
        content["address"].alias("address"),
        F.struct(content["phone"].alias("phone"), content["opening_hours"].alias("hours")).alias("contact"),
        F.struct(
            content["page_number"].alias("page_number"),
            content["subtitle"].alias("subtitle"),
            content["html"].alias("raw_html"),
        ).alias("data_json"),
        now.alias("cleaned_at"),
    )
    if sources is not None:
        cleaned = apply_stored_rules(cleaned, sources)
    if rules is None:
        return cleaned.withColumns({
            "validation_status": F.lit("valid"),
            "validation_errors": F.lit(None).cast(schemas.FIELD_ERRORS),
        })
    return cleaned.withColumns({"validation_status": rules.status(), "validation_errors": rules.errors()})


def with_ids(df: DataFrame, after: int = 0, name: str = "id") -> DataFrame:
    """Unique bigint ids above ``after`` without a global sort; gaps are normal.

    Partition p numbers its rows p, p + 2^24, p + 2*2^24, ...  Write the frame before
    using the ids: a second evaluation may number the rows differently.
    """
    m = F.monotonically_increasing_id()
    partition = F.shiftright(m, 33)
    row = m.bitwiseAND(F.lit((1 << 33) - 1))
    slot = F.when(partition < ID_SLOTS, partition).otherwise(
        F.raise_error(F.lit("more partitions than id slots")).cast("bigint")
    )
    return df.select((row * ID_SLOTS + slot + F.lit(after + 1)).alias(name), *df.columns)
