"""The filter audit, spelling variants and address filters."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import filter_audit, spelling_variants, url_filter

from awkward_texts import AWKWARD

SF = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor " * 120_000 + "#"


def same_as_sql(df, sql, **views):
    con = duckdb.connect()
    for name, frame in views.items():
        con.register(name, frame.toArrow())
    names = sorted(df.columns)
    key = lambda row: [(v is None, v) for v in row]
    ours = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    theirs = con.sql(f"select {', '.join(names)} from ({sql})").fetchall()
    assert ours == sorted(theirs, key=key)
    return ours


# ---- filter audit ------------------------------------------------------------------------


def plain_audit(rows, good, toxic):
    """Every document through every order, one filter after the other."""
    masks = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            fails.add("E")
        masks.append((source or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {m[0] for m in masks}:
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [m for m in masks if m[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                shapley[letter] += len(gone)
                failing = [m for m in masks if m[0] == part and letter in m[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(m[1] == {letter} for m in failing),
                                          sum(m[2] for m in gone), sum(m[3] for m in gone), letter]
        for key in out:
            if key[0] == part:
                out[key][-1] = shapley[out[key][-1]]
    return out


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int, source string, text string")


def test_audit_equals_running_every_order(documents, labels, prose):
    r = random.Random(1)
    base = [prose(i, n) for i, n in enumerate([3, 210, 250, 400])]
    texts = AWKWARD + [LONG, LONG] + [t + r.choice(["", " #", " ABCDEFGHIJ" * 9, " go" * 400]) for t in base for _ in range(6)]
    sources = [r.choice([None, "", "a", "b"]) for _ in texts]
    ids = list(range(len(texts)))
    ids[5], ids[-1] = None, ids[-2]
    docs = documents(texts, ids, sources)
    marks = labels(*[(i, r.choice([0, 1, None]), r.choice([0, 1]), "x", "y") for i in range(0, len(texts), 2)], (4, 1, 0, "x", "y"), (None, 1, 1, "x", "y"))
    good = {m.doc_id for m in marks.collect() if m.quality == 1 and m.doc_id is not None}
    toxic = {m.doc_id for m in marks.collect() if m.toxic == 1 and m.doc_id is not None}
    got = {(x.part, x.filter_order, x.step): [x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost, x.shapley]
           for x in filter_audit.op11(docs, marks).collect()}
    assert got == plain_audit(list(zip(ids, texts, sources)), good, toxic)


def test_audit_equals_sql(documents, labels, table):
    docs, marks = table("documents"), table("labels")
    rows = same_as_sql(filter_audit.op11(docs, marks), filter_audit.OP11_SQL, documents=docs, labels=marks)
    assert len(rows) == 600 * docs.select("source").distinct().count()


def test_audit_without_documents_or_labels(documents, labels):
    assert filter_audit.op11(documents([]), labels()).collect() == []
    out = filter_audit.op11(documents(["x"]), labels()).collect()
    assert len(out) == 600 and {x.good_lost for x in out} == {0} and sum(x.removed for x in out) == 120


def test_lehmer_ranks_and_intervals():
    for rank, order in enumerate(filter_audit.ORDERS):
        assert filter_audit.lehmer_rank(order) == rank
        assert filter_audit.lehmer_rank(order[:2]) <= rank < filter_audit.lehmer_rank(order[:2]) + 6
    for mask in range(32):
        ends = filter_audit.interval_ends(mask)
        for rank, order in enumerate(filter_audit.ORDERS):
            steps = [step for step in range(1, 6) if sum(x for s, at, x in ends if s == step and at <= rank)]
            fails = [i for i, letter in enumerate(order, 1) if mask >> filter_audit.FILTERS.index(letter) & 1]
            assert steps == fails[:1]


# ---- spelling variants -------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def variants(docs):
    out = [(x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling_variants.op12(docs).collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_variants_equal_all_pairs(documents):
    r = random.Random(2)
    letters = "abé÷"
    stems = ["".join(r.choice(letters) for _ in range(n)) for n in (6, 6, 7, 8, 9, 13, 30)]
    words = Counter()
    for stem in stems:
        words[stem] += 700
        for depth in range(40):
            at, kind, word = r.randrange(len(stem)), r.randrange(3), r.choice(list(words)) if depth % 3 else stem
            at = min(at, len(word) - 1)
            word = word[:at] + ("" if kind == 0 else r.choice(letters)) + word[at + (kind != 1) :]
            words[word] += r.choice([4, 5, 6, 25, 30, 150])
    runs = [w for w, n in words.items() for _ in range(n)]
    r.shuffle(runs)
    texts = AWKWARD + [" ".join(w.upper() if r.random() < 0.1 else w for w in runs[i::40]) for i in range(40)] + ["Shortx " * 50_000 + "x" * 100_000]
    rows = [(None if i == 14 else i, t) for i, t in enumerate(texts)]
    expected = plain_variants(rows)
    assert any(x[2] not in (x[0], x[1]) for x in expected), "chains of forms are tested"
    assert variants(documents(texts, [i for i, _ in rows])) == expected


def test_each_edit_shares_a_key(spark):
    r = random.Random(3)
    pairs = []
    for n in range(6, 16):
        word = "".join(r.choice("abcdé") for _ in range(n))
        for at in range(n + 1):
            pairs += [(word, word[:at] + "x" + word[at:]), (word, word[:at] + "x" + word[at + 1 :])]
            if n > 6 and at < n:
                pairs.append((word[:at] + word[at + 1 :], word))
    pairs = [(a, b) for a, b in pairs if len(a) >= 6 and len(b) in (len(a), len(a) + 1) and one_edit(a, b)]
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("shift", F.length("b") - F.length("a"))
    size = F.length("a")
    met = F.arrays_overlap(spelling_variants.keys(F.col("a"), size, F.lit(0)), spelling_variants.keys(F.col("b"), size, F.col("shift")))
    assert rows.filter(~met).collect() == []


def test_variants_equal_sql(table):
    docs = table("documents", "/root/testdata/sf0.01")
    same_as_sql(spelling_variants.op12(docs), spelling_variants.OP12_SQL, documents=docs)


def test_variants_of_nothing(documents):
    assert variants(documents([])) == set() and variants(documents([None, "", "a b c", "Wonder"])) == set()
    assert variants(documents(["Wonder wonder"] * 5)) == plain_variants([(i, "Wonder wonder") for i in range(5)])


# ---- address filters ---------------------------------------------------------------------

PAGES = "page_id bigint, url string, host string, verdict string, key string"


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "clash", "clash") for i, u in enumerate(urls)], PAGES)


def plain_verdict(url, listed):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    if best:
        return host, path, *best
    labels = host.split(".")
    blocked = any(".".join(labels[i:]) in listed for i in range(len(labels))) and host != ""
    return host, path, None, "block" if blocked else "allow"


URLS = [
    None, "", "no address", "://", "http://", "https:///path", "http://?q", "HTTP://Example.ORG/es/", "http://example.org/es", "http://org",
    "http://org/", "http://forg/", "http://x.com/fr/1", "http://x.com/de/1?y#z", "http://x.com/fr", "http://example.org/en/1234", "http://aexample.org/en/1",
    "http://a.example.org/en/2", "http://bad.net", "http://A.BAD.net/x://y", "http://notbad.net/", "http://bad.net.example", "http://é.net/ü", "a://b#c/d",
    "http://" + "a." * 400 + "bad.net/", "http://" + "x" * 200_000 + ".net/" + "y" * 200_000, "http://bad.net", "http://..net", "http://x.net\n/y",
]


def test_verdicts_equal_plain_ones(spark):
    r = random.Random(4)
    urls = URLS + [f"http://h{r.randrange(3000)}.s{r.randrange(40)}.net/{r.choice(['en/1', 'de/', ''])}" for _ in range(4000)]
    listed = {"bad.net", "s7.net", "unknown.net"} | {f"h{i}.s{i % 40}.net" for i in range(0, 3000, 3)}
    rows = spark.createDataFrame([(d,) for d in listed], "domain string")
    for most in (url_filter.KEYS_PER_FILTER, 300):
        got = url_filter.judged(pages_of(spark, urls), rows, keys_per_filter=most)
        assert sorted((x.page_id, x.host, x.path, x.rule, x.verdict) for x in got.collect()) == [(i, *plain_verdict(u, listed)) for i, u in enumerate(urls)]


def test_cascade_alternates_and_is_exact(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    levels = url_filter.cascade(keys)
    assert len(levels) > 3 and levels[0].hashes > 1 and {x.hashes for x in levels[1:]} == {1}
    assert [x.size for x in levels[2:]] <= [x.size for x in levels[:-2]]
    wrong = keys.filter(url_filter.is_listed(levels, F.col("key")) != F.col("listed"))
    assert wrong.count() == 0
    alone = keys.filter(url_filter.is_listed(levels[:1], F.col("key")) != F.col("listed"))
    assert alone.count() > 0, "one filter is not exact"


def test_verdicts_equal_sql(spark, table):
    pages = table("pages", "/root/testdata/sf0.01").unionByName(pages_of(spark, URLS).withColumn("html", F.lit("")).select("page_id", "url", "html"))
    rows = same_as_sql(url_filter.op13(pages), url_filter.OP13_SQL, pages=pages)
    assert {x[-1] for x in rows} == {"allow", "block"}


def test_verdicts_are_native(spark):
    plan = url_filter.op13(pages_of(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_no_pages(spark):
    assert url_filter.op13(pages_of(spark, [])).collect() == []
    assert url_filter.op13(pages_of(spark, [None])).collect()[0].asDict() == {"page_id": 0, "host": "", "path": "", "rule": None, "verdict": "allow"}
