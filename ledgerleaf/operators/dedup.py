"""Exact duplicates, history lookups and stop conditions.

Groups may be arbitrarily hot.  Grouping is always an aggregate with a map-side partial, so
a key holding a third of the rows reaches the reducer as one row per map task; rows meet
per-key results in joins whose hot partitions AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import join_reduced


def _order(order: Sequence[str]):
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def never_null(order: Sequence[str]):
    """An order that `min_by` never skips: NULLs behind all values."""
    return F.struct(*[part for c in order for part in (F.col(c).isNull(), F.col(c))])


def first_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Whole row of each key's earliest arrival; ``order`` must be unique within a key.

    Rows without an order value come last.  Rows without a key are one group.
    ``min_by`` carries the row through one shuffle with one candidate per map task and key.
    """
    payload = F.struct(*[c for c in df.columns if c != key])
    firsts = df.groupBy(key).agg(F.min_by(payload, never_null(order)).alias("_row"))
    taken = [F.col(key) if c == key else F.col("_row").getField(c).alias(c) for c in df.columns]
    return firsts.select(*taken)


def first_ids(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """(key, smallest id): the narrow form, a hash aggregate over two columns."""
    return df.groupBy(key).agg(F.min(row_id).alias(row_id))


def drop_seen(items: DataFrame, history: DataFrame, key: str = "hash") -> DataFrame:
    """Items whose key is not in the history (NULL keys are never seen before).

    For items with one row per key, such as those of `first_wins`: the partitioning that
    left is reused.  The history is reduced to its distinct keys, so that repeated keys
    there cannot heat up the join.
    """
    seen = history.select(key).where(F.col(key).isNotNull()).distinct()
    return items.join(seen, key, "left_anti")


def drop_seen_repeating(items: DataFrame, history: DataFrame, key: str = "hash") -> DataFrame:
    """`drop_seen` for items whose keys may repeat without bound."""
    return join_reduced(items, history.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def drop_seen_probing(items: DataFrame, history: DataFrame, key: str = "hash") -> DataFrame:
    """`drop_seen` for a small batch against a long history.

    The history is probed with the batch's keys (broadcast while the batch is under the
    broadcast threshold) instead of being shuffled; only the hits meet the items.
    """
    batch = items.select(key).where(F.col(key).isNotNull()).distinct()
    hits = join_reduced(history.select(key), batch, key, "left_semi").distinct()
    return items.join(hits, key, "left_anti")


def duplicate_keys(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def duplicate_texts(df: DataFrame, text: str, row_id: str, count: str = "count") -> DataFrame:
    """`duplicate_keys` for long texts: digests are shuffled, not the texts.

    One id per repeated digest fetches the text afterwards; ``row_id`` must be unique.
    """
    repeated = (
        df.select(F.sha2(F.col(text), 256).alias("_digest"), row_id)
        .groupBy("_digest")
        .agg(F.count("*").alias(count), F.min(row_id).alias(row_id))
        .where(F.col(count) > 1)
        .select(row_id, count)
    )
    return df.select(row_id, text).join(repeated, row_id).select(text, count)


def take_until_stop(df: DataFrame, group: str, order: Sequence[str], stop) -> DataFrame:
    """Rows of each group up to and including the first that satisfies ``stop``.

    Rows in groups that never stop, whose group is NULL, or that have no order value, are all
    kept.  Only the stop rows are aggregated, to
    one row per group; the data itself is joined to that, never sorted per group.
    """
    at = _order(order)
    stops = df.where(stop).groupBy(group).agg(F.min(at).alias("_stop"))
    kept = join_reduced(df, stops, group, "left").where(F.col("_stop").isNull() | at.isNull() | (at <= F.col("_stop")))
    return kept.select(*df.columns)


def pages_until_empty(pages: DataFrame, counts: str = "n_entries") -> DataFrame:
    """Listing pages a sequential reader sees: it stops after the first empty page."""
    return take_until_stop(pages, "source_id", ["page_number"], F.col(counts) == 0)


#: A listing is one run's reading of one source; either may be NULL.
LISTING = ["source_id", "run_id"]


def _listing(df: DataFrame) -> DataFrame:
    return df.withColumn("_listing", F.to_json(F.struct(*LISTING)))


def listing_stops(pages: DataFrame, items: DataFrame, known: DataFrame) -> DataFrame:
    """(source_id, run_id, page_number): each listing's first page without items, where it lies before the known one.

    Page numbers and ids alone are read.  ``items`` includes pages that could not be read, if
    they have a page number: those are not empty.
    """
    one = F.to_json(F.struct(*LISTING, "page_number"))
    filled = items.select(one.alias("_page")).distinct()
    asked = pages.where(F.col("page_number").isNotNull()).select(*LISTING, "page_number", one.alias("_page"))
    first = join_reduced(asked, filled, "_page", "left_anti").groupBy(*LISTING).agg(F.min("page_number").alias("page_number"))
    before = _listing(known).groupBy("_listing").agg(F.min("page_number").alias("_stop"))
    new = join_reduced(_listing(first), before, "_listing", "left_anti", F.col("_stop") <= F.col("page_number"))
    return new.select(*LISTING, "page_number")


def up_to_stop(items: DataFrame, stops: DataFrame) -> DataFrame:
    """Items on pages that are not behind their listing's stop; items without a page number all stay."""
    firsts = _listing(stops).groupBy("_listing").agg(F.min("page_number").alias("_stop"))
    late = F.col("_stop") < F.col("page_number")
    return join_reduced(_listing(items), firsts, "_listing", "left_anti", late).select(*items.columns)
