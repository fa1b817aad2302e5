"""Token counts, licence scans and the source mix."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from ledgerleaf.llm import license_scan, source_mix, token_counts

from awkward_texts import AWKWARD

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def model_path():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_equal_the_encoder(documents, table, model_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    r = random.Random(3)
    texts = AWKWARD + ["<s> </s> <unk> <0x0A>", "  lead", "trail  ", "a\n\nb \n c", "▁x ▁▁ y", ";\r\n{\r", "ﬁ½Å é á", "​﻿"]
    texts += ["".join(r.choice("ab \n▁é日;\r{") for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += [row.text for row in table("documents").limit(60).collect()]
    got = {row.doc_id: row for row in token_counts.token_counts(documents(texts), model_path, limit=100).collect()}
    for i, text in enumerate(texts):
        assert got[i].n_tokens == len(model.encode(text or "")), repr(text)[:80]
        assert got[i].n_bytes == len((text or "").encode())
        assert got[i].over_limit == (got[i].n_tokens > 100)


def test_token_counts_do_not_depend_on_what_is_remembered(documents, model_path, prose):
    docs = documents([prose(i, 200) for i in range(5)])
    assert sorted(token_counts.token_counts(docs, model_path, cached=3).collect()) == sorted(token_counts.token_counts(docs, model_path).collect())


def plain_licence(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licence_base_places(documents):
    r = random.Random(5)
    vocabulary = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "é", "x", "mit", "license"]
    texts = AWKWARD + [r.choice([" ", "-", ", "]).join(r.choice(vocabulary) for _ in range(80)) for _ in range(150)]
    texts += ["CC-BY-NC cc by nc by nc", "under the MIT license under the mit license", "Apache License, Version 2.0", "undér the mit license"]
    for row in license_scan.license_scan(documents(texts)).collect():
        n_words, n_base, first, last, labels = plain_licence(texts[row.doc_id])
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == (n_words, n_base, first, last, labels)
        assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(","))) and 0 <= row.score <= 1


@pytest.mark.parametrize("text,canonical,permitted", [
    ("mit", "mit", True),
    ("mit or gpl-3.0-only", "(mit or gpl-3.0-only)", True),
    ("mit and gpl-3.0-only", "(mit and gpl-3.0-only)", False),
    ("gpl-2.0 with classpath-exception-2.0 or mit and isc", "(gpl-2.0 with classpath-exception-2.0 or (mit and isc))", True),
    ("(mit or gpl-2.0) and lgpl-2.1", "((mit or gpl-2.0) and lgpl-2.1)", False),
    ("mit */ and more", "(mit and more)", False),
    ("mit) or x", "mit", True),
])
def test_licence_expressions(text, canonical, permitted):
    got = license_scan.parse_expression(text)
    assert (got[0], got[2]) == (canonical, permitted)


@pytest.mark.parametrize("text", ["", "or mit", "(mit", "mit and", "(", ")"])
def test_no_licence_expression(text):
    assert license_scan.parse_expression(text) is None


def test_licence_tags(documents):
    row = license_scan.license_scan(documents(["// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode"])).first()
    assert row.labels == "apache-2,bsd,mit" and row.permitted and row.score == 1.0
    assert row.expression == "((mit or apache-2.0) and bsd-3-clause)"


def test_mix_equals_its_sql(spark, table, tmp_path, documents):
    texts = [None, "", "a b c", "a b c", "word " * 40, "x y", "one", " lead", "p q r s", "t"]
    sources = ["b", "b", "a", "a", None, "é", "Z", "Z", "zero", ""]
    for docs in (table("documents"), documents(texts, ids=[0, 1, 2, 2, 4, None, 6, 7, 8, 9], sources=sources)):
        path = str(tmp_path / f"d{docs.count()}")
        docs.write.parquet(path)
        con = duckdb.connect()
        con.execute(f"create view documents as select doc_id, text, source from '{path}/*.parquet'")
        want = con.sql(source_mix.OP4_SQL).fetchall()
        got = [tuple(r) for r in source_mix.op4(docs).collect()]
        key = lambda r: tuple((v is None, v or 0) for v in r)
        assert sorted(got, key=key) == sorted(want, key=key)
        assert all(r[4] <= 2 * r[1] for r in got)


def test_mix_meets_its_targets_and_repeats_rows(documents, prose):
    docs = documents([prose(i, 20 + i % 7) for i in range(3000)], sources=[f"s{i % 3 if i % 2 else 0}" for i in range(3000)])
    rows = source_mix.op4(docs).collect()
    by_target = {}
    for r in rows:
        by_target.setdefault(r.target, []).append(r.taken)
    for target, taken in by_target.items():
        assert abs(sum(taken) - target) < 0.08 * target
    mixed = source_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r.size for r in rows)
    assert sorted(rows) == sorted(source_mix.op4(docs.repartition(7)).collect())


def test_empty_tables(documents, model_path):
    none = documents([])
    assert token_counts.token_counts(none, model_path).collect() == []
    assert license_scan.license_scan(none).collect() == []
    assert source_mix.op4(none).collect() == []
