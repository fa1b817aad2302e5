from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from support import collected
from ledgerleaf import schemas
from ledgerleaf.functions import html as H, json as J, text as X, url as U

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
NOT_SPACES = "​᠎﻿x"


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[1] for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=SPACES + NOT_SPACES + "aä€😀", max_size=30), min_size=1, max_size=40))
def test_clean_text_equals_python(spark, texts):
    assert column(spark, texts, X.clean_text("c")) == [" ".join(t.split()) for t in texts]
    assert column(spark, texts, X.strip("c")) == [t.strip() for t in texts]


def test_every_code_point_is_classified_like_python(spark):
    chars = [chr(c) for c in range(1, 0x3100)]
    got = column(spark, [f"a{c}b" for c in chars], X.clean_text("c"))
    assert got == [" ".join(f"a{c}b".split()) for c in chars]


def test_clean_text_cases(spark):
    assert column(spark, ["  A  B\n\tC ", None, "", " \t"], X.clean_text("c")) == ["A B C", "", "", ""]


@pytest.mark.parametrize("texts, expected", [
    ([], ("", "")), (["a"], ("a", "")), (["a", "b"], ("a", "b")), (["a", "b", "c"], ("a", "c")),
    ([" ", "a", "\n"], ("a", "")), ([" a  b ", " "], ("a  b", "")),
])
def test_first_and_last(rows, texts, expected):
    df = rows("a array<string>", (texts,)).select(X.strip_all("a").alias("a"))
    assert tuple(df.select(*X.first_and_last("a")).first()) == expected


def test_phone(spark):
    given_ = ["+49 (0)30 / 12-34", "030 12 34", None, "n/a", " + 1 2"]
    assert column(spark, given_, X.standard_phone("c")) == ["+490301234", "0301234", "", "", "+12"]


def test_match_key(rows):
    df = rows("n string, c string", (" Dr.  Vet ", "BERLIN"), ("", "x"), (None, "x"), ("a", None))
    assert [r[0] for r in df.select(X.match_key("n", "c")).collect()] == ["dr. vet|berlin", None, None, "a|"]


def test_json_text_and_int(rows):
    df = rows("d string", ('{"a": null}',), ("{}",), ('{"a": "abc"}',), ('{"a": "7"}',), ('{"a": 8}',))
    got = df.select(J.json_text("d", "$.a"), J.json_int("d", "$.a"), J.bad_int("d", "$.a")).collect()
    assert [tuple(r) for r in got] == [
        (None, None, False), (None, None, False), ("abc", None, True), ("7", 7, False), ("8", 8, False),
    ]
    with pytest.raises(PySparkException):
        df.select(J.json_int("d", "$.a", strict=True)).collect()


def test_nested_json_text(rows):
    df = rows("d string", ('{"address": {"city": "Köln"}}',), ('{"address": null}',), ("{}",), ("broken",))
    assert [r[0] for r in df.select(J.json_text("d", "$.address.city")).collect()] == ["Köln", None, None, None]


def test_get_default(rows):
    df = rows("d string", ("{}",), ('{"a": null}',), ('{"a": "x"}',), ('{"a": {"b": "y"}}',))
    v = J.variant("d")
    got = df.select(J.get_default(v, "$.a"), J.get_default(v, "$.a.b")).collect()
    assert [tuple(r) for r in got] == [("", ""), (None, ""), ("x", ""), ('{"b":"y"}', "y")]


def test_canonical_json_sorts_every_level_and_keeps_nulls(rows):
    ddl = f"c {schemas.RAW_CONTENT.simpleString()}"
    df = rows(ddl, (("N", None, "", ("S", None), "", "", 3, "<b>"),))
    text = df.select(J.canonical_json(F.col("c"), schemas.RAW_CONTENT)).first()[0]
    doc = json.loads(text)
    assert text == json.dumps(doc, sort_keys=True, separators=(",", ":"))
    assert doc["subtitle"] is None and doc["address"] == {"street": "S", "city": None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.recursive(
    st.none() | st.booleans() | st.integers(-10**9, 10**9) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("ab'é", max_size=2), inner, max_size=3),
    max_leaves=8,
), min_size=2, max_size=20))
def test_open_documents_are_equal_when_python_says_so(spark, docs):
    forms = [json.dumps(d, sort_keys=True) for d in docs]
    hashes = column(spark, [json.dumps(d) for d in docs], F.md5(J.canonical_variant(J.variant("c"))))
    assert [(a == b) for a in forms for b in forms] == [(a == b) for a in hashes for b in hashes]


def test_strings_of_any_length_are_hashed(spark):
    limit = 20_000_000  # where the plain parse function gives up
    texts = F.expr(f"explode(array({limit}, {limit + 1}, {limit + 1}))")
    docs = spark.range(1).select(texts.alias("n")).select(F.expr("""'{"b":1,"a":"' || repeat('x', n) || '"}'""").alias("d"))
    hashes = [r.h for r in docs.select(F.md5(J.canonical_variant(J.variant("d"))).alias("h")).collect()]
    assert None not in hashes and len(set(hashes)) == 2
    assert hashes[1] == hashlib.md5(('{"a":"' + "x" * (limit + 1) + '","b":1}').encode()).hexdigest()


def test_structs_in_arrays_are_sorted(spark):
    df = spark.sql("select named_struct('b', array(named_struct('z', 1, 'a', 2), null), 'a', array(3)) s")
    got = df.select(J.canonical_json(F.col("s"), df.schema["s"].dataType)).first()[0]
    assert got == '{"a":[3],"b":[{"a":2,"z":1},null]}'


def test_null_and_missing_fields_differ(rows):
    df = rows("d string", ('{"n": null}',), ("{}",), ('{"n": ""}',))
    assert len({r[0] for r in df.select(F.md5(J.canonical_variant(J.variant("d")))).collect()}) == 3


def test_key_order_does_not_matter(rows):
    df = rows("d string", ('{"a": {"x": 1, "y": 2}, "b": 3}',), ('{"b":3,"a":{"y":2,"x":1}}',))
    assert len({r[0] for r in df.select(F.md5(J.canonical_variant(J.variant("d")))).collect()}) == 1


def test_spaced_digest(spark):
    doc = {"name": "Zoë \U0001f600", "address": {"street": None, "city": "a\\b\"c"}, "n": 3}
    digest = hashlib.md5(json.dumps(doc, sort_keys=True).encode()).hexdigest()
    assert column(spark, [json.dumps(doc), None, "{bad", ""], J.spaced_json_md5("c")) == [digest, None, None, None]


def test_domains(spark):
    urls = ["https://example.com/a", "http://www.Example.com", "https://badexample.com", "no url", None,
            "https://example.com.evil.org", "https://example-com.de"]
    assert column(spark, urls, U.in_domain("c", "example.com")) == [True, True] + [False] * 5


def test_url_sequence(spark):
    got = U.url_sequence(spark, 3, "https://x.de/T.html", "https://x.de/T-Seite-%d.html")
    assert collected(got) == [
        (1, "https://x.de/T.html"), (2, "https://x.de/T-Seite-2.html"), (3, "https://x.de/T-Seite-3.html"),
    ]
    assert got.schema["page"].dataType.simpleString() == "int"


def test_native_html(rows):
    df = rows("h string", ("<h1>a &lt;b&gt; &amp;lt;</h1><h1>z</h1>",), ("<h1></h1>",), ("<p>x</p>",))
    assert [r[0] for r in df.select(H.first_text("h", "h1")).collect()] == ["a <b> &lt;", None, None]
