"""What five filters remove in each of their 120 orders, from counts of failure masks.

A document is removed by the first letter of an order that it fails, so its failures (a mask of
five bits) say in which orders it goes at which step: in those that begin with some letters it
passes and then one it fails.  Orders with a common beginning are neighbours in lexicographic
order, from the Lehmer rank of the beginning on.  So documents are only counted per mask; a
mask's counts are added where such intervals begin and taken off where they end, and a running
sum over the 120 ranks gives every order at once.
"""

from __future__ import annotations

import itertools
import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, let, staged, text_column

#: Fixed values of the filters, a letter each: too few words, too few different ones, too many
#: capitals, signs of markup, and a text that a smaller id has too.
FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
SIGNS = "[#$%&*|]"

ORDERS = tuple("".join(p) for p in itertools.permutations(FILTERS))
LATIN_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lehmer_rank(beginning: str) -> int:
    """Place of the first order that begins so, among all orders."""
    left, rank = list(FILTERS), 0
    for letter in beginning:
        digit = left.index(letter)
        left.pop(digit)
        rank += digit * math.factorial(len(left))
    return rank


def interval_ends(mask: int) -> list[tuple[int, int, int]]:
    """``step, rank, sign`` of every end of an interval of orders that remove the mask at that step.

    Intervals that touch lose the ends between them.
    """
    fails = [letter for i, letter in enumerate(FILTERS) if mask >> i & 1]
    passes = [letter for letter in FILTERS if letter not in fails]
    ends: Counter[tuple[int, int]] = Counter()
    for step in range(1, len(FILTERS) + 1):
        for before in itertools.permutations(passes, step - 1):
            for letter in fails:
                first = lehmer_rank("".join(before) + letter)
                ends[step, first] += 1
                ends[step, first + math.factorial(len(FILTERS) - step)] -= 1
    return [(step, rank, sign) for (step, rank), sign in sorted(ends.items()) if sign]


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at a text alone: A, B, C and D."""
    capitals = F.length(text) - F.length(F.translate(text, LATIN_CAPITALS, ""))
    tests = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda words: F.struct(
            (F.size(words) < LEAST_WORDS).alias("few"),
            (100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words)).alias("same"),
        ),
    )
    return let(tests, lambda t: sum(
        F.when(failed, 1 << i).otherwise(0)
        for i, failed in enumerate([t["few"], t["same"], 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike(SIGNS)])
    ))


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask``, one row per row of ``docs``.

    Texts are scanned once and leave 32 bytes each.  The smallest id of a text is a plain minimum
    with partial results per task, and rows are matched with it on text and id together, so a
    text that a third of all rows share stays spread.  A null id is no smaller id and has none;
    rows that repeat an id and its text fail E only if a smaller id has that text.
    """
    text = text_column()
    narrow = staged(docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("text_key"), text_failures(text).alias("own"),
    ), "failures")
    first = narrow.filter("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    marked = narrow.join(first.withColumn("is_first", F.lit(True)), ["text_key", "doc_id"], "left")
    copy = F.when(F.col("is_first").isNull() & F.col("doc_id").isNotNull(), 1 << FILTERS.index("E")).otherwise(0)
    return marked.select("doc_id", "part", (F.col("own") + copy).alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: at most 32 rows per part, whatever the input.

    An id counts as good or toxic if any of its label rows says so; ids without labels are neither.
    """
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    return failures(docs).join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def order_totals(counts: DataFrame) -> DataFrame:
    """The audit's rows from ``part, mask, n, good, toxic``: 600 per part."""
    ends = [[{"step": s, "rank": r, "sign": x} for s, r, x in interval_ends(mask)] for mask in range(1 << len(FILTERS))]
    table = F.from_json(F.lit(json.dumps(ends)), "array<array<struct<step:int,rank:int,sign:int>>>")
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    ranks = F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1)))

    changes = counts.select("part", "n", "good", "toxic", F.explode(F.element_at(table, F.col("mask") + 1)).alias("end"))
    changes = changes.select("part", "end.step", "end.rank", *[(F.col("end.sign") * F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    grid = counts.select("part").distinct().select("part", steps.alias("step"))
    grid = grid.select("part", "step", ranks.alias("rank"), *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    dense = changes.filter(F.col("rank") < len(ORDERS)).unionByName(grid)
    dense = dense.groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])

    along = Window.partitionBy("part", "step").orderBy("rank")  # 120 rows
    removed = dense.select("part", "step", "rank", *[
        F.sum(c).over(along).alias(name) for c, name in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))])
    named = removed.withColumn("filter_order", F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1))
    named = named.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))

    def per_filter(count) -> Column:
        return F.create_map(*[x for i, letter in enumerate(FILTERS) for x in (F.lit(letter), count(1 << i))])

    failing = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        per_filter(lambda bit: failing(F.col("mask").bitwiseAND(bit) > 0)).alias("fails"),
        per_filter(lambda bit: failing(F.col("mask") == bit)).alias("alone"),
    )
    so_far = F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step"))  # 5 rows
    all_orders = F.sum("removed").over(Window.partitionBy("part", "letter"))  # 120 rows
    return named.join(totals, "part").select(
        "part", "filter_order", "step",
        (F.col("total") - so_far).alias("kept"),
        "removed",
        (F.col("fails")[F.col("letter")] - F.col("removed")).alias("redundant"),
        F.col("alone")[F.col("letter")].alias("unique_fails"),
        "good_lost", "toxic_lost",
        all_orders.alias("shapley"),
    )


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all documents: one row per part, order and step, zeros included.

    A null text is empty: it has no words and fails A alone, and E beside another empty text of
    smaller id.  A null source is the part of the empty name.  Repeated rows count each.  Without
    documents there are no parts and no rows.
    """
    return order_totals(mask_counts(docs.select("doc_id", "source", "text"), labels.select("doc_id", "quality", "toxic")))


OP11_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
failed as (
  select part, len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by t), false) as e,
    doc_id in (select doc_id from labels where quality = 1 and doc_id is not null) as good,
    doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null) as toxic
  from texts),
counted as (
  select part, concat(case when a then 'A' else '' end, case when b then 'B' else '' end, case when c then 'C' else '' end,
      case when d then 'D' else '' end, case when e then 'E' else '' end) as fails,
    count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select concat(l1.x, l2.x, l3.x, l4.x, l5.x) as filter_order
  from letters l1, letters l2, letters l3, letters l4, letters l5
  where len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
steps as (select filter_order, step, substr(filter_order, step, 1) as letter from orders, range(1, 6) r(step)),
gone as (
  select part, filter_order, fails, n, good, toxic,
    (select min(instr(filter_order, x)) from letters where contains(fails, x)) as step
  from counted, orders where fails <> ''),
removed as (
  select part, filter_order, step, sum(n) as removed, sum(good) as good_lost, sum(toxic) as toxic_lost from gone group by all),
totals as (
  select part, x as letter, sum(n) as total, coalesce(sum(n) filter (where contains(fails, x)), 0) as failing,
    coalesce(sum(n) filter (where fails = x), 0) as alone
  from counted, letters group by all),
dense as (
  select t.part, s.filter_order, s.step, s.letter, t.total, t.failing, t.alone,
    coalesce(r.removed, 0) as removed, coalesce(r.good_lost, 0) as good_lost, coalesce(r.toxic_lost, 0) as toxic_lost
  from steps s join totals t using (letter)
  left join removed r on r.part = t.part and r.filter_order = s.filter_order and r.step = s.step)
select part, filter_order, step::int as step,
  (total - sum(removed) over (partition by part, filter_order order by step))::bigint as kept,
  removed::bigint as removed, (failing - removed)::bigint as redundant, alone::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from dense
"""
