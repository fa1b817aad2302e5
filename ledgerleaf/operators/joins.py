"""Join shapes shared by reports and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def with_matching_ids(facts: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Facts whose ``key`` is among ``ids`` (one id column); planned, not run, when called."""
    return join_reduced(facts, ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")


def join_reduced(facts: DataFrame, reduced: DataFrame, key: str, how: str,
                 condition: Column | None = None) -> DataFrame:
    """Join facts, hot keys and all, to a frame that an aggregate left one row per key of.

    AQE splits an oversized partition only where both inputs of the join come straight out
    of a shuffle made for it.  The aggregate's own partitioning on the key would do for the
    join and rule that out, so the key's hash is a second join key: the reduced rows are
    shuffled once more, and a key with a third of the facts is spread over many tasks.
    ``condition`` may compare columns of both sides; the key comes out once.
    """
    other = "_key_of_reduced"
    right = reduced.withColumnRenamed(key, other)
    # Hashes depend on the type where equality does not: widen both keys to one type first.
    types = facts.schema[key].dataType, right.schema[other].dataType
    hashes = [F.hash(F.coalesce(k, *[F.lit(None).cast(t) for t in types])) for k in (facts[key], right[other])]
    on = (facts[key] == right[other]) & (hashes[0] == hashes[1])
    if condition is not None:
        on = on & condition
    return facts.join(right, on, how).drop(other)


def per_key(facts: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    """Facts reduced to one row per key before any join, so hot keys never meet a join."""
    return facts.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti").select(*child.columns)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows plus incoming rows with a new key; columns are matched by name.

    A new key that arrives several times is inserted once, with the least of its rows.  Rows
    without a key are all inserted.
    """
    fresh = join_reduced(incoming, existing.select(key).distinct(), key, "left_anti")
    rest = [c for c in incoming.columns if c != key]
    if rest:
        once = fresh.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
        once = once.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in incoming.columns])
    else:
        once = fresh.where(F.col(key).isNotNull()).distinct()
    fresh = once.unionByName(fresh.where(F.col(key).isNull()))
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert(existing: DataFrame, changes: DataFrame, key: str, touch: Column | None = None) -> DataFrame:
    """Existing rows with the columns of ``changes`` laid over them, plus rows with new keys.

    ``changes`` holds at most one row per key.  NULL in a change keeps the old value;
    ``touch`` sets ``updated_at`` on rows that changed and on no others.
    """
    old, new = existing.alias("old"), changes.withColumn("_changed", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    out = []
    for c in existing.columns:
        if c == "updated_at" and touch is not None:
            out.append(F.when(F.col("new._changed"), touch).otherwise(F.col("old.updated_at")).alias(c))
        elif c in changes.columns:
            out.append(F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c))
        else:
            out.append(F.col(f"old.{c}").alias(c))
    return joined.select(*out)


def fill_defaults(df: DataFrame, defaults: dict[str, object], now: Column | None = None,
                  timestamps: Sequence[str] = ()) -> DataFrame:
    """Insert-time defaults: NULL or missing columns take their default."""
    new = {}
    for name, value in defaults.items():
        new[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    for name in timestamps:
        clock = F.current_timestamp() if now is None else now
        new[name] = F.coalesce(F.col(name), clock) if name in df.columns else clock
    return df.withColumns(new) if new else df
