from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from tessera.llm.common import Scratch, ship_package

LONG = "word " * 40_000

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("size", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("slot", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("a b.c", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def ready(spark):
    ship_package(spark)
    return spark


@pytest.fixture()
def work(ready):
    return Scratch(ready, "test")


def make_docs(spark, rows):
    """``rows`` of (doc_id, text, source); the other columns hold clutter."""
    full = [(i, t, "en", s, len(t or ""), *["x"] * 7) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls in every column used, empty, long, equal and repeated rows, odd letters."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("al", "be", "cor", "dun", "é", "ß") for b in ("na", "to", "ri", "Sk", "'s", "9")]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), f"s{i % 4}") for i in range(60)]
    rows += [(60, None, "s1"), (61, "", "s1"), (62, " \t\n ", None), (63, LONG, "s2"), (None, "null id here", "s0")]
    rows += [(None, "null id here", "s0"), (64, rows[0][1], None), (65, rows[0][1], "s9"), (65, rows[0][1], "s9")]
    rows += [(66, "İstanbul Σίσυφος ÀÉ <|endoftext|> 日本語 é", ""), (67, "\x1c\x1f x", "")]
    return rows


@pytest.fixture(scope="session")
def odd(ready):
    return make_docs(ready, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(ready):
    return make_docs(ready, [])
