from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from support import collected
from ledgerleaf.functions import text as X
from ledgerleaf.operators import consolidate, enrich, validate

CLEANED = (
    "id bigint, raw_data_id bigint, source_id bigint, name string, category string, "
    "address struct<street: string, city: string>, contact struct<phone: string, hours: string>, at string"
)


def cleaned(rows, *data):
    return rows(CLEANED, *data).withColumn("cleaned_at", F.col("at").cast("timestamp")).drop("at")


def rec(i, name="N", city="C", source=1, category="cat", street="S", phone="1", hours="h", at="2024-01-01"):
    return (i, 100 + i, source, name, category, (street, city), (phone, hours), at)


def test_validation_states(rows):
    df = cleaned(rows, rec(1), rec(2, name=" "), rec(3, street=None), rec(4, phone="\t"), rec(5, hours=""),
                 rec(6, name=None, city=""), rec(7, name="x" * 256))
    got = {r.id: (r.validation_status, [tuple(e) for e in r.validation_errors])
           for r in validate.validate(df).collect()}
    assert got == {
        1: ("valid", []), 2: ("invalid", [("name", "missing")]), 3: ("partial", [("street", "missing")]),
        4: ("partial", [("phone", "missing")]), 5: ("valid", []),
        6: ("invalid", [("name", "missing"), ("city", "missing")]), 7: ("valid", [("name", "too_long")]),
    }


def test_standardize(rows):
    df = cleaned(rows, rec(1, name="  A \n B", city=None, phone="+49 30/1 2", hours=" Mo  Di "))
    row = validate.standardize(df).first()
    assert (row.name, row.address, row.contact) == ("A B", ("S", ""), ("+493012", "Mo Di"))
    again = validate.standardize(validate.standardize(df)).first()
    assert again == row


def test_source_rules(rows):
    df = rows("source string, a string, b string", ("x", "q", "r"), ("y", "q", "r"), (None, "q", "r"))
    rules = {"x": {"a": F.upper, "b": lambda c: F.concat(c, F.lit("!"))}, "y": {"a": lambda c: F.lit("z")}}
    assert collected(validate.apply_source_rules(df, rules)) == [(None, "q", "r"), ("x", "Q", "r!"), ("y", "z", "r")]
    assert validate.apply_source_rules(df, {}) is df


STORED_RULES = """{"rules": {"name": [{"op": "replace", "pattern": "-+", "value": " "}, {"op": "upper"}],
                             "place.city": [{"op": "default", "value": "nowhere"}]}}"""


def test_stored_rules(rows):
    df = rows("source_id bigint, name string, place struct<city: string, zip: string>",
              (1, "a--b", (None, "z")), (2, "a--b", ("X", "z")), (None, "c-d", None), (3, None, None), (4, "e", (" ", "q")))
    sources = rows("id bigint, config string", (1, STORED_RULES), (4, STORED_RULES), (2, "no json"), (3, None),
                   (2, '{"rules": {"name": []}}'), (9, '{"rules": {"name": [{"op": "lower"}]}}'))
    got = validate.apply_stored_rules(df, sources)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, "A B", ("nowhere", "z")), (2, "a--b", ("X", "z")), (None, "c-d", None), (3, None, None), (4, "E", ("nowhere", "q")),
    ], key=str)
    assert validate.apply_stored_rules(df, sources.where("id = 3")) is df
    assert validate.apply_stored_rules(df.limit(0), sources).count() == 0


@pytest.mark.parametrize("rules", ['{"name": [{"op": "drop"}]}', '{"title": [{"op": "upper"}]}', '{"place": [{"op": "upper"}]}'])
def test_stored_rules_that_cannot_be_meant(rows, rules):
    df = rows("source_id bigint, name string, place struct<city: string>", (1, "a", None))
    with pytest.raises(ValueError, match="source rules name"):
        validate.apply_stored_rules(df, rows("id bigint, config string", (1, '{"rules": %s}' % rules)))


def test_look_up_and_enriched_rows(rows):
    df = rows("id bigint, zip string", (1, "10115"), (2, "99999"), (3, None))
    ref = rows("code string, lat double", ("10115", 52.5), ("10117", 52.6))
    got = enrich.look_up(df, ref, "zip", "code", ["lat"])
    assert collected(got) == [(1, "10115", 52.5, 1.0), (2, "99999", None, None), (3, None, None, None)]
    hits = enrich.enriched_rows(df, ref, F.col("zip"), "code", ["lat"], "geo", "zip table").collect()
    assert [(r.cleaned_data_id, r.enrichment_type, json.loads(r.data), r.source, r.confidence_score) for r in hits] == [
        (1, "geo", {"lat": 52.5}, "zip table", 1.0)
    ]


def test_cross_reference(rows):
    df = rows("k string, s string", ("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "x"), (None, "x"), (None, "y"),
              ("c", "x"), ("c", None))
    assert collected(enrich.cross_reference(df, "k", "s")) == [("a", 3, 2)]


def test_master_records_pick_the_best_value_per_field(rows):
    df = cleaned(
        rows,
        rec(1, "Dr. Vet", "Berlin", 3, category="", phone="", street="old", at="2024-01-01"),
        rec(2, " dr.  VET", "BERLIN ", 2, category="k", phone="22", street="new", at="2024-03-01"),
        rec(3, "Dr. Vet", "Berlin", 3, category="best", phone=None, street=" ", at="2024-02-01"),
        rec(4, "", "Berlin", 9), rec(5, None, "Berlin", 9), rec(6, "Dr. Vet", "Köln", 2),
    )
    scores = rows("cleaned_data_id bigint, confidence_score double", (3, 0.5), (3, 0.9), (1, 0.1), (99, 1.0))
    got = consolidate.master_records(df, scores)
    assert got.count() == 2
    m = got.where("address.city ilike 'berlin%'").first()
    assert (m.name, m.type, m.address.street, m.contact.phone) == ("Dr. Vet", "best", "old", "22")
    assert json.loads(m.primary_data) == {"id": 3, "raw_data_id": 103, "source_id": 3}
    assert m.sources == [2, 3] and m.confidence_score == 0.9 and json.loads(m.data_json) == {"record_count": 3}
    assert str(m.created_at) == "2024-01-01 00:00:00" and str(m.updated_at) == "2024-03-01 00:00:00"
    key = rows("n string, c string", ("Dr. Vet", "Berlin")).select(F.md5(X.match_key("n", "c"))).first()[0]
    assert m.external_id == key


def test_master_ties_go_to_later_then_smaller_id(rows):
    df = cleaned(rows, rec(5, phone="five", at="2024-02-01"), rec(4, phone="four", at="2024-02-01"),
                 rec(1, phone="one", at="2024-01-01"))
    m = consolidate.master_records(df).first()
    assert m.contact.phone == "four" and m.confidence_score is None and json.loads(m.primary_data)["id"] == 4


def test_merge_resolve_lineage(rows):
    df = rows("k string, id int, s string, q int", ("a", 1, "x", None), ("a", 2, "y", 1), ("a", 3, "x", 1), ("b", 4, None, 0),
              (None, 5, "x", 9))
    assert collected(consolidate.merge(df, "k", "id", "s")) == [("a", 1, 3, 3, 2), ("b", 4, 4, 1, 0)]
    best = consolidate.resolve(df, "k", [F.col("q").isNull(), -F.col("q"), F.col("id")], ["id", "q"])
    assert collected(best) == [("a", 2, 1), ("b", 4, 0)]
    assert collected(consolidate.lineage(df, "k", "s")) == [("a", ["x", "y"])]


def test_retry_list(rows):
    failures = rows("u string, at int", ("a", 1), ("a", 5), ("b", 1), ("c", 3))
    successes = rows("u string, at int", ("a", 4), ("a", 2), ("c", 3))
    assert collected(consolidate.retry_list(failures, successes, "u", "at")) == [("a", 5), ("b", 1), ("c", 3)]
