from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from support import collected, listing
from ledgerleaf.functions import html as H
from ledgerleaf.operators import extract
from ledgerleaf.registry.extraction import NAV_RULES


@pytest.fixture
def read(spark):
    """read(page) or read(page, rules) -> entry rows in order"""

    def rows(page: str, rules=extract.LISTING) -> list[dict]:
        found = extract.page_entries(spark.createDataFrame([(page,)], "html string"), rules)
        return [r.asDict() for r in found.orderBy("entry_pos").collect()]

    return rows


def test_listing_fields(read):
    first, second = read(listing(("A", "Weg 1", "10115 Berlin"), ("B", "Weg 2", "Köln")))
    assert first["name"] == "A" and first["url"] == "/d/A" and first["subtitle"] == "sub\n A"
    assert first["category"] == "Cat" and first["phone"] == "00 12" and first["opening_hours"] == "Mo–Fr"
    assert [t.strip() for t in first["address_texts"]] == ["Weg 1", "10115 Berlin"]
    assert second["name"] == "B"
    assert first["html"].startswith('<div class="hit clearfix">') and first["html"].endswith("</div></div>")
    assert first["html"].count("<div") == first["html"].count("</div>")


def test_missing_parts_are_null(read):
    (row,) = read('<div class="hit"><h2>no link</h2></div>')
    assert row["name"] is None and row["url"] is None and row["phone"] is None
    assert row["address_texts"] == []
    assert read("<div class='hits'></div>") == [] and read("") == []


def test_class_must_match_as_a_word(read):
    assert [r["html"] for r in read('<div class="hit">a</div><div class="hit2">b</div><p class="hit">c</p>')] == [
        '<div class="hit">a</div>'
    ]


def test_first_direct_text_of_any_match(read):
    (row,) = read(
        '<div class="hit"><div class="subline"><b>inner</b></div><div class="subline">x<i>y</i>z</div></div>'
    )
    assert row["subtitle"] == "x"


def test_text_only_below_the_right_ancestors(read):
    (row,) = read(
        '<div class="hit"><a class="hitlnk_name" href="/no">no</a>'
        '<h2><span><a class="hitlnk_name" href="/yes">yes</a></span></h2></div>'
    )
    assert (row["name"], row["url"]) == ("yes", "/yes")


def test_nested_entries_both_count(read):
    outer, inner = read('<div class="hit">o<div class="hit">i</div></div>')
    assert outer["html"] == '<div class="hit">o<div class="hit">i</div></div>'
    assert inner["html"] == '<div class="hit">i</div>'


def test_broken_markup(read):
    rows = read('<div class="hit"><b>x<div class="category">c</b></div></div><div class="hit"><p>one<p>two')
    assert [r["html"] for r in rows] == [
        '<div class="hit"><b>x<div class="category">c</b></div></div>', '<div class="hit"><p>one<p>two',
    ]
    assert rows[0]["category"] == "c"


def test_comments_scripts_and_void_elements(read):
    page = (
        '<!-- <div class="hit">no</div> --><script>var s = \'<div class="hit">\';</script>\n\n'
        '<div\n class="hit"><br/><img src="a>b"><address>a<!-- c -->b<br>&amp; c</address></div>'
    )
    (row,) = read(page)
    assert row["address_texts"] == ["a", "b", "& c"]
    assert row["html"] == page[page.index("<div\n"):]


def test_items_from_pages(spark):
    pages = spark.createDataFrame(
        [(7, 3, 2, listing(("Dr.  A", "Weg 1", "Berlin"), ("B", "Nur Straße", ""))), (7, 3, 3, "<html></html>"),
         (7, 3, 4, None)],
        "source_id bigint, run_id bigint, page_number int, html string",
    )
    items = extract.listing_items(pages).orderBy("entry_pos").collect()
    assert [(r.page_number, r.entry_pos, r.url) for r in items] == [(2, 0, "/d/Dr.  A"), (2, 1, "/d/B")]
    first = items[0].raw_content
    assert (first.name, first.subtitle, first.phone) == ("Dr. A", "sub Dr. A", "00 12")
    assert (first.address.street, first.address.city) == ("Weg 1", "Berlin")
    assert (items[1].raw_content.address.street, items[1].raw_content.address.city) == ("Nur Straße", "")
    assert first.page_number == 2 and first.html.startswith("<div") and len(items[0].hash) == 32
    assert items[0].address_error is None


def test_same_listing_on_another_page_has_another_hash(spark):
    page = listing(("A", "S", "C"))
    pages = spark.createDataFrame(
        [(1, 1, 1, page), (1, 1, 2, page), (2, 9, 1, page)],
        "source_id bigint, run_id bigint, page_number int, html string",
    )
    hashes = {(r.source_id, r.page_number): r.hash for r in extract.listing_items(pages).collect()}
    assert hashes[1, 1] != hashes[1, 2] and hashes[1, 1] == hashes[2, 1]


def test_native_patterns_agree_with_the_reader(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    native = pages.select(
        "page_id", F.posexplode(F.arrays_zip(H.link_texts("html").alias("t"), H.link_targets("html").alias("u")))
    ).select("page_id", "pos", "col.t", "col.u")
    parsed = extract.page_entries(pages.select("page_id", "html"), NAV_RULES)
    assert collected(native) == collected(parsed.select("page_id", "entry_pos", "name", "url"))
    titles = extract.EntryRules(entry="head", texts={"title": "title"})
    parsed_titles = extract.page_entries(pages.select("page_id", "html"), titles)
    native_titles = pages.select("page_id", H.first_text("html", "title"))
    assert collected(native_titles) == collected(parsed_titles.select("page_id", "title"))


def test_entry_with_optional_end_tag(read):
    rules = extract.EntryRules(entry="li", texts={"t": "li"})
    page = "<ul><li>a<li>b<b>c</b></ul><p>x</p><LI>d</li></body>"
    assert [(r["t"], r["html"]) for r in read(page, rules)] == [
        ("a", "<li>a"), ("b", "<li>b<b>c</b>"), ("d", "<LI>d</li>"),
    ]


def test_attributes(read):
    (row,) = read("<div data-x='>' class='a&#32;hit b'><h2><A HREF=/x&amp;y class=hitlnk_name>n<b>m</A></h2>< b")
    assert row["url"] == "/x&y" and row["name"] == "n" and row["html"].endswith("< b")
    rules = extract.EntryRules(entry=".k", attrs={"v": (".k", "v")})
    assert [r["v"] for r in read('<p class="k j" v="1" v="2"><i class=k v></i></p><p class="kk" v="3">', rules)] == ["1", ""]


def test_broken_markup_is_read_in_linear_time(spark):
    import time

    n, deep = 4_000, 1_000
    pages = ['<div class="hit">' + "<" * n * 10, '<div class="' * n, '<div class="hit"><a b="' * deep,
             "<div class='hit'><a b=" * deep, "<!--" * n, "<!" * n, "<script>" * n + "x" * n,
             '<div class="hit">' + "<b>x" * deep, '<div class="hit">' + '<a class="hitlnk_name" href="u">' * deep,
             '<div class="hit">' + "<address>" * deep + "x", '<div class="hit">' + "</b>" * n,
             '<div class="hit">' + "<i>" * deep + "</b>" * n, '<div class="hit">' + "<p a=1 " + "b=2 " * n, "<a b='>" * n]
    found = extract.page_entries(spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(14), extract.LISTING)
    start = time.perf_counter()
    assert found.select("i").distinct().count() >= 8
    assert time.perf_counter() - start < 60


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, 1, 1, "")], "source_id bigint, run_id bigint, page_number int, html string")
    plan = extract.listing_items(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|MapInArrow|MapInPandas|PythonUDF", plan)


def test_entities_equal_the_standard(spark):
    import html
    import random

    r = random.Random(1)
    texts = ["&amp;&lt;", "&notit; &copyfoo &#8211; &#x80; &#0; &#xD800; &#1114112; &uuml;&nbsp;x", "& &; &#; &#x; &&amp;amp; &NotEqualTilde;",
             "&#99999999999999;", "&#128;&#13;&#11;&#65535;", "", "plain", "&" * 5000, "&amp;" * 5000]
    parts = ["&", "#", "x", "12", "8364", ";", "amp", "notin", "copy", "a", " ", "Auml", "eacute;", "é"]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {x.i: x.u for x in rows.select("i", H.unescape("t").alias("u")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]
    assert spark.range(1).select(H.unescape(F.lit(None).cast("string"))).first()[0] is None
