"""Similarity join, decontamination, long repeats and the pipeline, against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerleaf.llm import components, decontaminate, jaccard_join, personal_data, quality_mil, source_mix, suffix_dedup
from awkward_texts import AWKWARD


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_classes(ids, texts, similarity=0.8):
    sets = [shingles(t) for t in texts]
    links, root = [0] * len(ids), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (least[find(i)], links[i]) for i, d in enumerate(ids)}


def variants(text, n, seed, edits):
    r = random.Random(seed)
    for _ in range(n):
        words = text.split()
        for _ in range(edits):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def texts(prose):
    one, two, passage = prose(1, 200), prose(2, 300), prose(3, 120)
    out = AWKWARD + [prose(i, 80) for i in range(100, 160)]
    out += [one, one, one.upper(), *variants(one, 60, 4, 1), *variants(two, 40, 5, 3), *variants(two, 15, 6, 9)]
    return out + [prose(i, 60) + " " + passage + " " + prose(i + 1, 60) for i in range(200, 230)] + ["a b c", "a b c", "a b", "a b c d e f"]


def test_join_equals_brute_force(documents, texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 16)  # splits, unproductive splits and tiles
    want = plain_classes(list(range(len(texts))), texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.op8(documents(texts)).collect()}
    assert got == want


def test_join_on_the_driver_table(table):
    docs = table("documents")
    rows = docs.collect()
    want = plain_classes([r.doc_id for r in rows], [r.text for r in rows])
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.op8(docs).collect()} == want


def test_one_of_each_class(documents, texts):
    ids = [i % 150 for i in range(len(texts))]
    docs = documents(texts, ids=ids)
    kept = jaccard_join.one_of_each_class(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    classes = plain_classes(list(range(len(texts))), texts)
    n_classes = len({c for i, (c, _) in classes.items() if shingles(texts[i])})
    assert sum(bool(shingles(r.text)) for r in rows) == n_classes
    assert sum(not shingles(r.text) for r in rows) == sum(not shingles(t) for t in texts)
    again = documents(["same words in both of these rows"] * 3, ids=[4, 4, None])
    assert [r.doc_id for r in jaccard_join.one_of_each_class(again).collect()] == [4]
    assert jaccard_join.op8(documents([])).collect() == []


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    got = {v.vertex: v.component for v in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    root = {v: v for p in pairs for v in p}
    for _ in range(300):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {v: c for v, c in root.items() if v != 500}


# ---- decontamination ---------------------------------------------------------------------


def tidy(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def plain_leaks(docs, items):
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    lists = {k: tidy(t) for k, t in items.items() if len(tidy(t)) >= 5}
    df = Counter(g for w in lists.values() for g in grams(w))
    weight = lambda g: np.log1p(len(lists) / df.get(g, 1))
    out = {}
    for d, text in docs.items():
        words = tidy(text)
        own = grams(words)
        for k, item in lists.items():
            want = grams(item)
            if not own & want:
                continue
            for s in range(max(1, len(words) - 4)):
                window = grams(words[s : s + len(item)])
                total = sum(map(weight, window | want))
                share = sum(map(weight, window & want)) / total
                if share >= 0.8 and share > out.get((d, k), (0, 0))[0] + 1e-12:
                    out[d, k] = (share, s)
    return out


def test_leaks_equal_brute_force(documents, spark, table, prose):
    items = {r.item_id: r.text for r in table("benchmark").collect()} | {900: "too short", 901: None, 902: prose(50, 60)}
    benchmark = spark.createDataFrame([(k, v, "x") for k, v in items.items()] + [(None, "no id at all here", "x")], "item_id bigint, text string, words string")
    rows = {r.doc_id: r.text for r in table("documents").collect()}
    real = [t for t in items.values() if t and len(tidy(t)) > 20]
    for i, t in enumerate(real[:12]):
        rows[5000 + i] = prose(i, 40) + " " + t + " " + prose(i + 70, 30)
        rows[5100 + i] = t.upper()
        words = t.split()
        rows[5200 + i] = prose(i, 10) + " " + " ".join(words[: len(words) // 2])
        rows[5300 + i] = " ".join([*words[:-1], "other"])
    long = prose(50, 60).split()
    rows[5400] = " ".join([*long[:30], "inserted", *long[30:]])
    ids = list(rows)
    docs = documents([rows[i] for i in ids] + AWKWARD, ids=ids + [7000 + i for i in range(len(AWKWARD))])
    want = plain_leaks(rows, items)
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert {k: round(v, 9) for k, v in found.items()} == {k: round(v[0], 9) for k, v in want.items()}
    kept = decontaminate.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {k[0] for k in want}


def test_edited_passages_of_every_item(documents, table):
    """Items with words at an end replaced or cut off, however far that moves the fingerprint."""
    benchmark = table("benchmark", "/root/testdata/sf0.1")
    items = {r.item_id: r.text for r in benchmark.collect()}
    r, pool, texts = random.Random(4), [w for t in items.values() for w in tidy(t)], []
    for i, words in enumerate(map(tidy, items.values())):
        n = 1 + i % 5
        other = r.sample(pool, n)
        texts += [" ".join(t) for t in (other + words[n:], words[:-n] + other, words[n:], words[:-n])]
    want = plain_leaks(dict(enumerate(texts)), items)
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.contaminated(documents(texts), benchmark).collect()}
    assert len(want) > 400
    assert found == {k: round(v[0], 9) for k, v in want.items()}


def test_no_benchmark(documents, spark):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(documents(["a b c d e f"]), benchmark).collect() == []
    assert decontaminate.decontaminated(documents(["a b c d e f", None]), benchmark).count() == 2


def test_bit_blocks_cover_all_bits(spark):
    row = spark.range(1).select(F.explode(decontaminate.bit_blocks(F.lit(-1).cast("bigint"))).alias("b")).select("b.*").collect()
    assert len(row) == decontaminate.RADIUS + 1 and sum(int(r.bits).bit_count() for r in row) == 64


# ---- long repeats ------------------------------------------------------------------------


def plain_repeats(texts):
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if starts[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(d, gone) if not g)
        yield len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept


@pytest.fixture(scope="module")
def repeats(prose):
    r = random.Random(8)
    passage, other = prose(30, 90), prose(31, 400)
    out = AWKWARD + [prose(i, 150) for i in range(300, 310)]
    out += [prose(i, r.randint(1, 50)) + passage[r.randint(0, 150) : r.randint(340, 420)] + prose(i + 1, r.randint(1, 50)) for i in range(320, 350)]
    out += [other, other, *variants(other, 12, 3, 2)]
    out += [prose(40, 30) + "x" + passage[:200], "y" + passage[:200], passage[:199], passage[10:210], "z" + passage[5:204]]
    out += [("ab" * 300), "ab" * 120 + "c" + "ab" * 120, "é" * 260, "\x00" * 450, "q" * 199, "r" * 200, "s" * 201, passage + passage]
    return out


def check_repeats(docs, texts):
    rows = {r.doc_id: r for r in suffix_dedup.without_repeats(docs).collect()}
    for i, (n_bytes, n_removed, n_spans, kept) in enumerate(plain_repeats(texts)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n_bytes, n_removed, n_spans), (i, texts[i] and texts[i][:60])
        assert bytes(r.kept) == kept and r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_equal_brute_force(documents, repeats):
    check_repeats(documents(repeats).repartition(5), repeats)


def test_repeats_in_small_blocks_and_parts(documents, repeats, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 700)
    monkeypatch.setattr(suffix_dedup, "COMPARED", 8)
    check_repeats(documents(repeats), repeats)


def test_repeats_on_the_driver_table(table):
    rows = table("documents").collect()
    want = {r.doc_id: w for r, w in zip(rows, plain_repeats([r.text for r in rows]))}
    for r in suffix_dedup.op9(table("documents")).collect():
        n_bytes, n_removed, n_spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n_bytes, n_removed, n_spans, hashlib.sha256(kept).hexdigest())


def test_repeats_of_nothing(documents):
    assert suffix_dedup.op9(documents([])).collect() == []


def test_index_levels_shrink(prose):
    index = suffix_dedup.SuffixIndex()
    r = np.random.default_rng(0)
    for i in range(20):
        rows = r.integers(97, 99, (7, suffix_dedup.CONTEXT)).astype(np.uint8)
        index.add(index.keys(rows), np.arange(7 * i, 7 * i + 7))
    sizes = [len(k) for k, _ in index.levels]
    assert sum(sizes) == 140 and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    assert all((k[1:] >= k[:-1]).all() for k, _ in index.levels)


# ---- the pipeline ------------------------------------------------------------------------


def text_scans(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("text:string")


def test_kept_documents_move_once(spark, table, tmp_path):
    """One pass moves the texts where no rows share id and text; where some do, one of them is kept."""
    docs = table("documents")
    kept = jaccard_join.one_of_each_class(docs)
    assert text_scans(kept) == 1
    docs.union(docs.limit(40)).write.parquet(str(tmp_path / "again"))
    again = jaccard_join.one_of_each_class(spark.read.parquet(str(tmp_path / "again")))
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in kept.collect())


def test_few_cuts_are_sent_to_the_texts(spark, table, monkeypatch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = personal_data.redacted(table("documents"))
        plan = sent._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(personal_data, "SENT_CUTS", 0)
        moved = personal_data.redacted(table("documents"))
        assert "SortMergeJoin" in moved._jdf.queryExecution().sparkPlan().toString()
        assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, moved.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pipeline_equals_its_stages_done_plainly(spark, table):
    """Every stage on the rows that the plain version of the one before it kept."""
    sf = "/root/testdata/sf0.001"
    docs = table("documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "redaction", "mixing"]
    model = quality_mil.train(docs, table("labels"), ~quality_mil.held_out())
    import pyarrow as pa

    rows = [r.asDict() for r in docs.collect()]
    scores = model.score(*quality_mil.encode(pa.array([r["text"] or "" for r in rows])))
    rows = [r for r, s in zip(rows, scores) if s >= 0.3]
    classes = plain_classes([r["doc_id"] for r in rows], [r["text"] for r in rows])
    rows = [r for r in rows if classes[r["doc_id"]][0] == r["doc_id"] or not shingles(r["text"])]
    leaks = {d for d, _ in plain_leaks({r["doc_id"]: r["text"] for r in rows}, {r.item_id: r.text for r in table("benchmark").collect()})}
    rows = [r for r in rows if r["doc_id"] not in leaks]
    left = spark.createDataFrame(rows, docs.schema)
    spans = {r.doc_id: r.spans for r in personal_data.op5(left).collect()}
    for r in rows:
        for kind, a, b in sorted((s.split(":") for s in spans[r["doc_id"]].split(",") if s), key=lambda s: -int(s[1])):
            r["text"] = r["text"][: int(a)] + f"[{kind.upper()}]" + r["text"][int(b) :]
        r["n_chars"] = len(r["text"])
    want = Counter()
    sized = {r.doc_id: r for r in source_mix.op4(spark.createDataFrame(rows, docs.schema)).collect()}
    for r in rows:
        s = sized[r["doc_id"]]
        if s.size:
            want[tuple(r.values())] += s.taken // s.size
    got = Counter(tuple(r.asDict()[c] for c in docs.columns) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == +want
