from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"

@pytest.fixture
def documents(spark):
    """documents(texts) -> table like ``documents``; ids count from 0, with columns of clashing names."""

    def make(texts, ids=None, sources=None):
        rows = [
            (i if ids is None else ids[i], t, "en", "s" if sources is None else sources[i], len(t or ""), "extra", 1, "k", 2.0)
            for i, t in enumerate(texts)
        ]
        ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key string, start int, kind string, score double"
        return spark.createDataFrame(rows, ddl)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n made-up words, every text its own."""

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(["ka", "lo", "mi", "ten", "sur", "ve", "da"]) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name, sf=SF: spark.read.parquet(f"{sf}/{name}.parquet")
