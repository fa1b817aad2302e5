"""Mixing sources to target weights by repetition rates.

Tokens are summed per source, the budget is dealt out by weight under a ceiling, and every
document is emitted floor(rate) times plus once more if a hash of its id falls under the
remaining fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, staged, text_column

# Fixed values of the mix: weights in the order of the sources, the budget as a share of all
# tokens, and the ceiling as a multiple of a source's own tokens.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CEILING = 2
SEED = "mix-1"


def size_column() -> Column:
    return F.regexp_count(text_column(), F.lit(WORD)).cast("long")


def source_targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING) -> DataFrame:
    """``source, source_size, target``, one row per source, nulls being one source.

    Sources in code point order, null last, take the weights in turn.  Filling water: going up
    from the source whose ceiling is reached first, a source is full if its ceiling lies under
    its share of what the full ones before it left; the others share the rest by weight.  The
    windows run over one row per source, after the documents are summed.
    """
    sums = docs.select(F.col("source").cast("string").alias("source"), size_column().alias("size"))
    sums = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = sums.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighted = numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    weighted = weighted.withColumn("most", ceiling * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    filled = weighted.select(
        "source", "source_size", "weight", "most",
        (budget * F.sum("source_size").over(Window.partitionBy())).alias("budget"),
        F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("spent"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("sharers"),
    )
    full = filled.withColumn("full", F.col("most") <= F.col("weight") * (F.col("budget") - F.col("spent")) / F.col("sharers"))
    everything = Window.partitionBy()
    full = full.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0)))
    full = full.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
    share = F.col("weight") * (F.col("budget") - F.col("taken")) / F.col("open")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), share))
    return full.select("source", "source_size", target.alias("target"))


def draw(seed: str = SEED) -> Column:
    """A number in [0, 1) from the id alone; rows without an id take their text instead."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_column()))
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def with_copies(docs: DataFrame, seed: str = SEED, **terms) -> DataFrame:
    """``docs`` with ``mix_source_size``, ``mix_target`` and ``mix_copies``, the times a row is taken.

    The table of sources is written first, so that the join sees its true size: under the
    session's threshold it is broadcast, beyond it a hot source is split by adaptive execution.
    A source without words has rate 0.  Repeated rows draw alike.
    """
    targets = staged(source_targets(docs, **terms), "source-targets").select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    joined = docs.join(targets, docs["source"].cast("string").eqNullSafe(F.col("mix_source")), "left").drop("mix_source")
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    extra = F.when(draw(seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("mix_copies", (F.floor(rate) + extra).cast("int"))


def mixed_documents(docs: DataFrame, **terms) -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, with its own columns only."""
    taken = with_copies(docs, **terms).filter("mix_copies > 0")
    return taken.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def op4(docs: DataFrame) -> DataFrame:
    sized = with_copies(docs.select("doc_id", "source", "text"))
    out = sized.select("doc_id", size_column().alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), "mix_copies")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("mix_copies")).alias("taken"))


OP4_SQL = r"""
with sized as (
  select doc_id, source, coalesce(text, '') as text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
numbered as (select *, row_number() over (order by source nulls last) - 1 as place from sums),
weighted as (select *, ([3, 1, 2])[place % 3 + 1] as weight, 2 * source_size as most from numbered),
filled as (
  select *, 1.5::double * (select sum(source_size)::bigint from sums) as budget,
    coalesce(sum(most) over (order by most::double / weight, place rows between unbounded preceding and 1 preceding), 0)::double as spent,
    (sum(weight) over (order by most::double / weight, place rows between current row and unbounded following))::double as sharers
  from weighted),
judged as (select *, most <= weight * (budget - spent) / sharers as is_full from filled),
targets as (
  select source, source_size, case when is_full then most::double
    else least(most::double, weight * (budget - coalesce((select sum(most) from judged where is_full), 0)::double)
      / (select sum(weight) from judged where not is_full)::double) end as target
  from judged),
drawn as (
  select s.doc_id, s.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    ('0x' || substr(md5('mix-1:' || coalesce(cast(s.doc_id as varchar), md5(s.text))), 1, 13))::bigint / 4503599627370496::double as draw
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end))::bigint as taken
from drawn
"""
