from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from support import collected
from ledgerleaf.operators import ledger

T0 = datetime(2024, 5, 1, 10, 0, tzinfo=timezone.utc)
T1 = datetime(2024, 5, 1, 11, 30, tzinfo=timezone.utc)


def test_run_life(spark):
    changes = (
        ledger.open_run(spark, 1, 7, {"b": 1, "a": [2]}, T0)
        .unionByName(ledger.record_error(spark, 1, 2, "first", T0))
        .unionByName(ledger.record_error(spark, 1, 4, "second", T1))
        .unionByName(ledger.open_run(spark, 2, 7, None, T1))
    )
    progress = spark.createDataFrame([(1, 20, 18), (1, 5, 0)], "id bigint, items_seen bigint, items_new bigint")
    one, two = ledger.run_state(changes, progress).orderBy("id").collect()
    assert (one.source_id, one.status, one.items_processed, one.end_time) == (7, "running", 25, None)
    assert [(e.timestamp, e.error) for e in one.errors] == [
        ("2024-05-01T10:00:00", "first"), ("2024-05-01T11:30:00", "second"),
    ]
    assert json.loads(one.stats) == {"items_seen": 25, "items_new": 18}
    assert json.loads(one.config_snapshot) == {"a": [2], "b": 1}
    assert (two.errors, two.items_processed, two.config_snapshot) == (None, 0, None)

    closing = changes.unionByName(ledger.close_run(spark, 1, 5, T1))
    assert ledger.run_state(closing).where("id = 1").first().items_processed == 0
    closed = ledger.run_state(closing, progress).where("id = 1").first()
    assert closed.status == "completed" and closed.items_processed == 25
    assert (closed.end_time - closed.start_time).total_seconds() == 5400


def test_append_error(rows):
    df = rows("errors array<struct<timestamp: string, error: string>>", (None,), ([("t", "old")],))
    at = F.lit("2024-05-01 10:00:00.5").cast("timestamp")
    got = df.select(ledger.append_error(F.col("errors"), at, F.lit("new")).alias("e")).collect()
    assert [[tuple(x) for x in r.e] for r in got] == [
        [("2024-05-01T10:00:00.500000", "new")], [("t", "old"), ("2024-05-01T10:00:00.500000", "new")],
    ]


def test_new_sources(rows):
    known = rows("name string", ("a",), ("a",))
    incoming = rows("name string, url string", ("b", "u2"), ("b", "u1"), ("a", "x"), ("c", "u3"))
    got = ledger.new_sources(known, incoming, after=5).collect()
    assert sorted((r.name, r.url, r.is_active) for r in got) == [("b", "u1", True), ("c", "u3", True)]
    assert len({r.id for r in got}) == 2 and all(r.id > 5 and r.created_at and r.updated_at for r in got)


def test_get_or_create(rows):
    got = ledger.get_or_create(rows("name string", ("a",)), rows("name string", ("a",), ("b",), ("b",)))
    assert collected(got) == [("a", "old"), ("b", "new")]


def test_run_counts_include_duplicates_and_empty_results(rows):
    items = rows("run_id bigint", (1,), (1,), (2,), (None,))
    raw = rows("run_id bigint, error string", (1, None), (1, "failed copy"))
    assert collected(ledger.run_counts(items, raw)) == [(None, 1, 0), (1, 2, 1), (2, 1, 0)]
