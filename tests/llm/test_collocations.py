from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as co
from tests.llm.conftest import make_docs, odd_rows

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, most=5):
    count, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            own = count.setdefault(lang, Counter())
            for w in range(1, most + 1):
                own.update(tuple(words[i : i + w]) for i in range(len(words) - w + 1))
    out = []
    for lang, f in count.items():
        frequent = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = set()
        for g, a in frequent.items():
            for w in range(2, len(g)):
                inside.update(p for i in range(len(g) - w + 1) if 100 * a >= 100 * f[p := g[i : i + w]])
        scored = []
        for g, a in frequent.items():
            if g not in inside:
                score, k = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == list(NAMES)
    return sorted(tuple(r) for r in df.collect())


def prose(seed, words, rows=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    phrases = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 7))) for _ in range(words // 2)]
    out = []
    for i in range(rows):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", ", ", ".\n", "\t", "  "]))
        out.append((i, "".join(parts), f"s{i % 3}"))
    return out


@pytest.mark.parametrize("seed, words, least, top, shard", [(1, 6, 2, 50, 40), (2, 20, 3, 5000, 300), (3, 3, 1, 30, 10), (4, 40, 2, 9, 10**6)])
def test_phrases_match_brute_force(ready, work, seed, words, least, top, shard):
    rows = prose(seed, words) + odd_rows()
    langs = [None, "en", "und", "de"]
    docs = make_docs(ready, rows).repartition(5)
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)).cast("int") + 1)
    got = found(co.collocations(docs.withColumn("lang", lang), work, least, top, shard_words=shard))
    assert got == brute([(langs[(i or 0) % 4], t) for i, t, _ in rows], least, top)


@pytest.mark.parametrize("most", [2, 3, 4])
def test_shorter_phrases(ready, work, most):
    rows = prose(9, 5, 40)
    got = found(co.collocations(make_docs(ready, rows), work, 3, 100, max_words=most))
    assert got == brute([("en", t) for _, t, _ in rows], 3, 100, most)
    with pytest.raises(ValueError, match="max_words"):
        co.collocations(make_docs(ready, rows), work, 3, 100, max_words=6)


def test_overlaps_copies_and_whole_numbers(ready, work):
    rows = [(1, "a a a a a a a", "s")] * 30 + [(2, "É e É e Ab aB", "s")] * 4
    got = found(co.collocations(make_docs(ready, rows), work, 4, 100, shard_words=20))
    assert got == brute([("en", t) for _, t, _ in rows], 4, 100)
    assert ("en", 1) == got[0][:2]


def test_nothing_frequent_and_empty(ready, work, empty, odd):
    assert found(co.collocations(empty, work, 1, 10)) == []
    assert found(co.collocations(odd, work, 10**6, 10)) == []
    alone = make_docs(ready, [(1, "one. two", "s")] * 5)
    assert found(co.collocations(alone, work, 2, 10)) == []


def test_scores_are_exact_beyond_64_bits(ready, work):
    a, n, left, right = 10**12, 9 * 10**12, 10**12 + 7, 3 * 10**12 + 11
    one = ready.createDataFrame(
        [("en", ["x", "y"], [left, a], [right, a])], "lang string, words array<string>, heads array<long>, tails array<long>"
    )
    got = co._ranked([one], ready.createDataFrame([("en", n)], "lang string, n long"), one, 5).first()
    assert got["score"] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("shard", [200, 10**6])
def test_rare_ngrams_are_not_listed(ready, work, shard):
    """N-grams become rows in the shards only if they are frequent, though all of their words are."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=60)) + rng.choice([" x y z u v", "", " x y z"]), "s") for i in range(100)]
    docs = make_docs(ready, rows).repartition(4)
    got = found(co.collocations(docs, work, 30, 100, shard_words=shard))
    assert got == brute([("en", t) for _, t, _ in rows], 30, 100)
    frequent = Counter(g for _, t, _ in rows for w in range(2, 6) for g in zip(*[t.split()[k:] for k in range(w)]))
    frequent = {g for g, n in frequent.items() if n >= 30}
    shards = ready.read.parquet(f"{work.path}/0001-shards").count()
    listed = ready.read.parquet(f"{work.path}/*-grams").filter("prefix is not null")
    assert len(frequent) <= listed.count() <= len(frequent) * shards


def test_what_is_left_of_shards_is_one_shard(ready, work):
    """Shards of a language that hold a few frequent n-grams list each of them once, not once a shard."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(60)) + ", big red dog", "s") for i in range(200)]
    docs = make_docs(ready, rows).repartition(8)
    got = found(co.collocations(docs, work, 100, 100, shard_words=5000))
    assert got == brute([("en", t) for _, t, _ in rows], 100, 100)
    assert ready.read.parquet(f"{work.path}/0001-shards").count() == 8
    listed = ready.read.parquet(f"{work.path}/*-grams").filter("prefix is not null")
    assert listed.count() == 3


@pytest.mark.parametrize("most", [1, 5, 60, 10**6])
def test_stretches_share_their_zeros(most):
    rng = random.Random(most)
    text = np.array([0, *rng.choices(range(0, 4), k=300), 0], np.int32)
    cuts = list(co.stretches(text, most))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(b == c + 1 for (_, b), (c, _) in zip(cuts, cuts[1:]))
    assert all(text[a] == 0 == text[b - 1] for a, b in cuts)


def test_bucket_lists_hold_every_ngram():
    rng = random.Random(6)
    text = np.array([0, *rng.choices(range(0, 30), k=2000), 0], np.int32)
    marks = np.array([0, *rng.choices(range(2**32), k=29)], np.uint64)
    for width in range(1, 6):
        windows = Counter(w for w in zip(*[text[k:].tolist() for k in range(width)]) if 0 not in w)
        at, bucket = co.buckets(text, marks, width)
        assert len(at) == sum(windows.values())
        of = {tuple(text[i : i + width].tolist()): int(b) for i, b in zip(at, bucket)}
        want = Counter()
        for w, n in windows.items():
            want[of[w]] += n
        for parts in (1, 7):
            lists = [co._unpacked(x, 2).T.tolist() for x in co.bucket_lists(text, marks, width, parts) if x]
            assert {b: n for part in lists for b, n in part} == want
    assert co.bucket_lists(np.array([0], np.int32), marks, 2, 3) == [None] * 3


def test_both_halves_find_the_same_rows():
    """An n-gram's interval starts where the other half says, at every depth."""
    rng = random.Random(5)
    text = np.array([0, *rng.choices(range(0, 4), k=400), 0], np.int32)
    text, _ = co.restricted(text, text > 0)
    grams = {(int(w),): int(np.flatnonzero(text == w)[0]) for w in set(text.tolist()) - {0}}
    for width in range(1, 5):
        keys = list(grams)
        prefix, suffix, count, at, _ = co.longer_grams(text, np.array([grams[k] for k in keys]), width)
        got = {keys[p] + keys[s][-1:]: c for p, s, c in zip(prefix, suffix, count)}
        windows = zip(*[text[k:].tolist() for k in range(width + 1)])
        assert got == Counter(w for w in windows if 0 not in w)
        grams = {keys[p] + keys[s][-1:]: int(x) for p, s, x in zip(prefix, suffix, at)}
        assert all(tuple(text[x : x + width + 1].tolist()) == g for g, x in grams.items())
