from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from support import collected
from ledgerleaf.operators import dedup, joins


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9)), min_size=1, max_size=60), st.integers(1, 7))
def test_first_wins_for_any_partitioning(spark, pairs, parts):
    data = [(k, n, i) for i, (k, n) in enumerate(pairs)]
    expected = {}
    for k, n, i in sorted(data, key=lambda r: r[1:]):
        expected.setdefault(k, (k, n, i))
    random.Random(parts).shuffle(data)
    df = spark.createDataFrame(data, "k string, n int, i int").repartition(parts)
    once = dedup.first_wins(df, "k", ["n", "i"])
    assert collected(once) == sorted(expected.values())
    assert collected(dedup.first_wins(once, "k", ["n", "i"])) == collected(once)
    assert once.columns == df.columns


def test_drop_seen(rows):
    items = rows("hash string, n int", ("a", 1), ("b", 2), (None, 3))
    history = rows("hash string", ("b",), ("b",), (None,), ("z",))
    for f in (dedup.drop_seen, dedup.drop_seen_probing):
        assert collected(f(items, history).select("hash", "n")) == [(None, 3), ("a", 1)]
        assert f(items, history.limit(0)).count() == 3


def test_one_key_holding_a_third_of_the_rows(spark):
    n = 30_000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash")
    ).repartition(8)
    first = dedup.first_wins(df, "hash", ["id"])
    assert first.count() == 1 + n * 2 // 3
    assert first.where("hash = 'hot'").first()["id"] == 0
    assert collected(dedup.duplicate_keys(df, "hash")) == [("hot", n // 3)]


def test_duplicate_texts(rows):
    df = rows("id int, t string", (1, "x"), (2, "y"), (3, "x"), (4, None), (5, None), (6, "x"))
    assert collected(dedup.duplicate_texts(df, "t", "id")) == [(None, 2), ("x", 3)]
    assert collected(dedup.duplicate_keys(df, "t")) == [(None, 2), ("x", 3)]


def test_stop_at_first_empty_page(rows):
    pages = rows("source_id int, page_number int, n_entries int",
                 (1, 1, 20), (1, 2, 20), (1, 3, 0), (1, 4, 5), (1, 5, 0),
                 (2, 1, 3), (2, 2, 3), (3, 1, 0), (3, 2, 9))
    got = [(r[0], r[1]) for r in collected(dedup.pages_until_empty(pages))]
    assert got == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 1)]


def test_stop_with_unknown_group_and_ties(rows):
    df = rows("g string, t int, id int, stop boolean", (None, 1, 1, True), (None, 2, 2, False), ("a", 1, 5, False),
              ("a", 1, 6, True), ("a", 1, 7, False), ("a", None, 8, False))
    got = dedup.take_until_stop(df, "g", ["t", "id"], F.col("stop"))
    assert sorted(r.id for r in got.collect()) == [1, 2, 5, 6, 8]
    assert got.columns == df.columns


def test_drop_seen_with_repeating_keys(rows):
    items = rows("hash string, n int", ("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5), ("c", 6))
    got = dedup.drop_seen_repeating(items, rows("hash string", ("b",), ("b",), (None,)))
    assert collected(got, "n") == [("a", 1), (None, 4), ("c", 5), ("c", 6)]


@pytest.mark.parametrize("left, right", [("int", "bigint"), ("bigint", "int"), ("smallint", "decimal(12,0)"),
                                         ("double", "int"), ("date", "timestamp")])
def test_join_reduced_across_key_types(spark, left, right):
    made = "date'2024-01-01' + cast(id as int)" if left == "date" else "id"
    facts = spark.range(6).selectExpr(f"cast({made} as {left}) as k", "id as n")
    reduced = spark.range(2, 4).selectExpr(f"cast({made} as {right}) as k", "id as m")
    expected = [(i, i if i in (2, 3) else None) for i in range(6)]
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert collected(joins.join_reduced(facts, reduced, "k", "left").select("n", "m"), "n") == expected
        assert joins.join_reduced(facts, reduced, "k", "left_anti").count() == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_matching_ids(rows):
    facts = rows("k int, v string", (1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, "e"))
    ids = rows("id int", (2,), (3,), (3,), (9,))
    got = joins.with_matching_ids(facts, "k", ids)
    assert collected(got.select("k", "v")) == [(2, "b"), (2, "c"), (3, "e")]
    assert joins.with_matching_ids(facts, "k", ids.limit(0)).count() == 0


def test_orphans(rows):
    child = rows("id int, p int", (1, 1), (2, 9), (3, None))
    assert collected(joins.orphans(child, "p", rows("id int", (1,)), "id")) == [(2, 9)]


def test_insert_if_absent(rows):
    old = rows("k string, v int", ("a", 1))
    new = rows("k string, w int", ("a", 7), ("b", 8))
    got = joins.insert_if_absent(old, new, "k")
    assert got.columns == ["k", "v", "w"]
    assert collected(got) == [("a", 1, None), ("b", None, 8)]


def test_upsert_touches_changed_rows_only(rows):
    old = rows("id int, a string, b string, updated_at string", (1, "x", "p", "old"), (2, "y", "q", "old"))
    changes = rows("id int, a string", (2, "Y"), (3, "Z"))
    got = joins.upsert(old, changes, "id", touch=F.lit("now"))
    assert collected(got, "id") == [(1, "x", "p", "old"), (2, "Y", "q", "now"), (3, "Z", None, "now")]


def test_defaults(rows):
    df = rows("a int, t timestamp", (None, None), (5, None))
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    got = joins.fill_defaults(df, {"a": 1, "b": True}, now, ["t"])
    assert [(r.a, r.b, r.t.year) for r in got.orderBy("a").collect()] == [(1, True, 2024), (5, True, 2024)]


def test_a_new_key_is_inserted_once(rows):
    old = rows("k int, v string", (1, "a"))
    new = rows("k int, v string", (1, "z"), (2, "c"), (2, "b"), (None, "x"), (None, "x"))
    assert collected(joins.insert_if_absent(old, new, "k").where("k is not null")) == [(1, "a"), (2, "b")]
    assert joins.insert_if_absent(old, new, "k").where("k is null").count() == 2


def test_rows_without_an_order(rows):
    df = rows("k int, n int, v string", (1, None, "only"), (2, None, "late"), (2, 5, "early"))
    assert collected(dedup.first_wins(df, "k", ["n"]).select("k", "v")) == [(1, "only"), (2, "early")]
    pages = rows("source_id int, page_number int, n_entries int", (1, 1, 3), (1, 2, 0), (1, 3, 4), (1, None, 5))
    assert collected(dedup.pages_until_empty(pages).select("n_entries")) == [(0,), (3,), (5,)]
