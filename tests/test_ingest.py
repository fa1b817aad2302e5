from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from support import collected, content
from ledgerleaf.operators import ingest as I
from ledgerleaf.operators.validate import ValidationRules


def names(df):
    return sorted(r[0] for r in df.select("raw_content.name").collect() if r[0] is not None)


def test_first_copy_wins_across_sources(items, no_history):
    same = content()
    got = I.ingest(items((1, 2, 1, 0, "later-run", same), (9, 1, 1, 5, "first", same), (9, 1, 2, 0, "next", same)),
                   no_history)
    assert [r.url for r in got.raw.collect()] == ["first"]
    assert got.rejects.count() == 0


def test_page_number_is_part_of_the_content(items, no_history):
    got = I.ingest(items((1, 1, 1, 0, "a", content(page=1)), (1, 1, 2, 0, "b", content(page=2))), no_history)
    assert got.raw.count() == 2


def test_history_blocks_repeats(items, no_history):
    frame = items((1, 1, 1, 0, "a", content("A")), (1, 1, 1, 1, "b", content("B")))
    old = I.ingest(items((5, 5, 9, 9, "z", content("A"))), no_history).raw.select("hash")
    for probe in (False, True):
        assert names(I.ingest(frame, old, probe_history=probe).raw) == ["B"]


@pytest.mark.parametrize("field, n, kept", [("name", 255, 1), ("name", 256, 0), ("category", 255, 1), ("category", 256, 0)])
def test_length_limits(items, no_history, field, n, kept):
    got = I.ingest(items((1, 1, 1, 0, "a", content(**{field: "é" * n}))), no_history)
    assert got.raw.count() == kept
    assert [r.reason for r in got.rejects.collect()] == [f"too_long:{field}"] * (1 - kept)


def test_unknown_source_is_rejected_and_null_is_kept(items, no_history, rows):
    frame = items((1, 1, 1, 0, "known", content("A")), (2, 1, 1, 1, "unknown", content("B")),
                  (None, 1, 1, 2, "null", content("C")))
    got = I.ingest(frame, no_history, sources=rows("id bigint", (1,)), runs=rows("id bigint", (1,)))
    assert sorted(r.url for r in got.raw.collect()) == ["known", "null"]
    assert [(r.url, r.reason) for r in got.rejects.collect()] == [("unknown", "unknown_source")]
    got = I.ingest(frame, no_history, runs=rows("id bigint", (7,)))
    assert got.raw.count() == 0 and {r.reason for r in got.rejects.collect()} == {"unknown_run"}


def test_rejected_content_leaves_no_hash(items, no_history, rows):
    """A later valid copy is stored; a violating copy after a valid one is a mere duplicate."""
    known = rows("id bigint", (1,))
    same = content()
    bad_first = I.ingest(items((2, 1, 1, 0, "bad", same), (1, 1, 1, 1, "good", same)), no_history, known)
    assert [r.url for r in bad_first.raw.collect()] == ["good"]
    assert [r.url for r in bad_first.rejects.collect()] == ["bad"]
    good_first = I.ingest(items((1, 1, 1, 0, "good", same), (2, 1, 1, 1, "bad", same)), no_history, known)
    assert [r.url for r in good_first.raw.collect()] == ["good"] and good_first.rejects.count() == 0
    seen = good_first.raw.select("hash")
    assert I.ingest(items((2, 1, 1, 0, "bad", same)), seen, known).rejects.count() == 0


def test_address_cases(json_items, no_history):
    docs = [{"name": "n0"}, {"name": "n1", "address": None}, {"name": "n2", "address": "text"},
            {"name": "n3", "address": []}, {"name": "n4", "address": {}}, {"name": "n5", "address": {"city": None}},
            {"name": "n6", "address": 3}, {"name": "n7", "address": 1.0}, {"name": "n8", "address": True}]
    raw = I.ingest(json_items(*map(json.dumps, docs)), no_history).raw
    stored = {r.url: r for r in raw.where("error is null").collect()}
    errors = {r.url: r for r in raw.where("error is not null").collect()}
    assert {u for u, r in stored.items() if r.processing_status == "processed"} == {"u0", "u4", "u5"}
    assert stored["u0"].raw_content.address == ("", "") and stored["u5"].raw_content.address == ("", None)
    kinds = {"u1": "NoneType", "u2": "str", "u3": "list", "u6": "int", "u7": "float", "u8": "bool"}
    assert {u: r.error for u, r in errors.items()} == {
        u: f"'{k}' object has no attribute 'get'" for u, k in kinds.items()
    }
    for r in errors.values():
        assert r.hash is None and r.raw_content is None and r.processing_status == "failed"
    assert all(stored[u].hash and stored[u].processing_status == "failed" for u in kinds)


def test_failed_content_is_not_retried_and_ignores_lengths(json_items, no_history):
    doc = json.dumps({"name": "x" * 300, "address": None})
    first = I.ingest(json_items(doc, doc), no_history)
    assert first.raw.count() == 2 and first.rejects.count() == 0
    again = I.ingest(json_items(doc), first.raw.select("hash"))
    assert again.raw.count() == 0


def test_documents_that_are_no_object(json_items, no_history):
    got = I.ingest(json_items("[1]", "{broken", '{"name": "ok"}'), no_history)
    assert sorted(r.url for r in got.raw.where("processing_status = 'failed'").collect()) == ["u0", "u0"]
    assert [(r.url, r.reason) for r in got.rejects.collect()] == [("u1", "bad_json")]


def test_missing_and_null_text(json_items, no_history):
    got = I.ingest(json_items('{"phone": null}', '{"address": {}}'), no_history).raw.orderBy("url").collect()
    assert got[0].raw_content.phone is None and got[0].raw_content.name == ""
    assert got[1].raw_content.phone == "" and got[1].raw_content.page_number is None


def test_cleaned_rows(items, no_history):
    frame = items((4, 1, 3, 0, "a", content("N", "S", "C", 3, "<div>", "K", "12", "Mo", "sub")))
    raw = I.with_ids(I.ingest(frame, no_history).raw, after=10)
    row = I.cleaned_rows(raw).first()
    assert row.raw_data_id > 10 and row.source_id == 4
    assert (row.name, row.category, row.address, row.contact) == ("N", "K", ("S", "C"), ("12", "Mo"))
    assert row.data_json == (3, "sub", "<div>")
    assert row.validation_status == "valid" and row.validation_errors is None
    checked = I.cleaned_rows(raw, ValidationRules(required=("contact.hours", "address.city"))).first()
    assert checked.validation_status == "valid" and checked.validation_errors == []


def test_failed_rows_have_no_cleaned_row(json_items, no_history):
    raw = I.ingest(json_items('{"address": null}', "{}"), no_history).raw.withColumn("id", F.lit(1))
    assert I.cleaned_rows(raw).count() == 1


def test_failure_rows(rows):
    got = I.failure_rows(rows("source_id bigint, run_id bigint, url string, error string", (1, 2, "u", "timeout")))
    row = got.first()
    assert (row.url, row.error, row.hash, row.processing_status) == ("u", "timeout", None, "failed")
    assert got.columns == [c for c in got.columns if c != "id"]


def test_ids_are_unique_and_above_the_floor(spark):
    for parts in (1, 7):
        got = I.with_ids(spark.range(1000, numPartitions=parts).drop("x").withColumnRenamed("id", "n"), after=41)
        ids = [r.id for r in got.collect()]
        assert len(set(ids)) == 1000 and min(ids) == 42


@pytest.mark.parametrize("parts", [1, 5])
def test_result_does_not_depend_on_partitioning(items, no_history, parts):
    data = [(1, 1 + i % 2, i % 3, i, f"u{i}", content(f"n{i % 5}", page=1)) for i in range(40)]
    got = I.ingest(items(*data).repartition(parts), no_history).raw
    assert collected(got.select("url")) == [("u0",), ("u12",), ("u18",), ("u24",), ("u6",)]


def test_fetching_by_id_gives_the_same_rows(items, no_history, rows):
    data = [(1 + i % 3, 1 + i % 2, i % 3, i, f"u{i}", content(f"n{i % 5}" * (1 + 200 * (i % 7 == 0)), page=1))
            for i in range(40)]
    frame = items(*data).withColumn("item_id", F.col("entry_pos").cast("bigint"))
    known = rows("id bigint", (1,), (2,))
    old = I.ingest(items((1, 0, 0, 0, "z", content("n3", page=1))), no_history).raw.select("hash")
    for history in (no_history, old):
        carried = I.ingest(frame.drop("item_id"), history, known)
        fetched = I.ingest(frame, history, known, item_id="item_id")
        assert collected(fetched.raw.select("url", "hash")) == collected(carried.raw.select("url", "hash"))
        assert collected(fetched.rejects.select("url", "reason")) == collected(carried.rejects.select("url", "reason"))
        assert fetched.raw.columns == carried.raw.columns
