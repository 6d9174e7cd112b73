from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tessera.llm import language
from tessera.llm.queries import QUERIES
from tests.llm.conftest import make_docs, odd_rows

SF = "/root/testdata/sf0.01"


def cross_parse(text: bytes, sample: bytes) -> int:
    """Longest matches by trying every length, in stretches as the operator cuts them."""
    phrases = 0
    for at in range(0, len(text), language._STRETCH):
        stretch = text[at : at + language._STRETCH]
        i = 0
        while i < len(stretch):
            k = 1
            while i + k < len(stretch) and stretch[i : i + k + 1] in sample:
                k += 1
            i += k
            phrases += 1
    return phrases


@pytest.mark.parametrize("letters", [b"ab", b"abc ", bytes(range(1, 256))])
def test_automaton_reads_exactly_the_substrings(letters):
    rng = random.Random(len(letters))
    sample = bytes(rng.choices(letters, k=120))
    moves = language.suffix_automaton(sample)
    assert len(moves) <= 2 * len(sample)

    def reads(text):
        state = 0
        for b in text:
            if b not in moves[state]:
                return False
            state = moves[state][b]
        return True

    inside = {sample[i:j] for i in range(len(sample)) for j in range(i, min(len(sample), i + 12) + 1)}
    assert all(map(reads, inside))
    for _ in range(500):
        text = bytes(rng.choices(letters, k=rng.randint(1, 6)))
        assert reads(text) == (text in sample)


def test_phrases_match_brute_force():
    rng = random.Random(4)
    samples = {k: bytes(rng.choices(b"abcd ", weights=w, k=600)) for k, w in (("x", (5, 1, 1, 1, 2)), ("y", (1, 1, 1, 5, 2)), ("z", (2, 2, 0, 0, 1)))}
    texts = [bytes(rng.choices(b"abcde f", k=rng.choice((0, 1, 2, 30, 511, 512, 513, 2000)))) for _ in range(60)]
    got = language.Parser(samples).phrases(texts)
    assert got.tolist() == [[cross_parse(t, samples[k]) for k in sorted(samples)] for t in texts]


def test_documents_do_not_match_across_samples():
    parser = language.Parser({"x": b"ab\0cd", "y": b"xx"})
    assert parser.phrases([b"abcd", b"bc", b"\xff"]).tolist() == [[2, 4], [2, 2], [1, 1]]


def _query(spark, folder):
    return QUERIES["op13_language_id"](spark, str(folder))


def test_prediction_is_the_fewest_normalised_phrases(ready, tmp_path):
    docs = ready.read.parquet(f"{SF}/documents.parquet").limit(150).cache()
    samples = language.learn(docs, sample_documents=4)
    assert set(samples) == {r["lang"] for r in docs.select("lang").distinct().collect()}
    got = {r["doc_id"]: r for r in language.identify(docs, samples).collect()}
    for row in docs.collect():
        cost = {}
        for lang, sample in sorted(samples.items()):
            cost[lang] = cross_parse(language.letters(row["text"]), sample) * np.log2(len(sample))
        best, second = sorted(cost.values())[:2]
        assert got[row["doc_id"]]["lang_pred"] == min(cost, key=cost.get)
        assert got[row["doc_id"]]["score"] == pytest.approx(1 - best / second)


def test_held_out_accuracy(ready):
    docs = {r["doc_id"]: r["lang"] for r in ready.read.parquet(f"{SF}/documents.parquet").collect()}
    got = _query(ready, SF).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 150
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_documents_and_inputs_do_not_matter(ready):
    docs = ready.read.parquet(f"{SF}/documents.parquet").limit(300).collect()
    plain = [(r["doc_id"], r["text"], r["lang"]) for r in docs]
    turned = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in plain]
    make = lambda rows: ready.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.learn(make(plain))
    assert samples == language.learn(make(turned).repartition(7)) and "zz" not in samples
    first = sorted(language.identify(make(plain), samples).collect())
    assert first == sorted(language.identify(make([(i, t, None) for i, t, _ in plain]), samples).collect())


def test_odd_rows(ready, tmp_path, odd):
    rows = odd_rows() + [(80, "123 !? ²", "s"), (81, "日本", "s"), (82, "\x00\x00 a", "s")]
    make_docs(ready, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = _query(ready, tmp_path).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _, _ in rows)
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown == {60, 61, 62, 80} and all(r["lang_pred"] in ("und", "en") for r in got)
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_nothing_learnt_and_empty_table(ready, odd, empty, tmp_path):
    assert {r["lang_pred"] for r in language.identify(odd, {}).collect()} == {"und"}
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert _query(ready, tmp_path).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert _query(ready, tmp_path).count() == 0


def test_many_languages_share_the_table(ready, monkeypatch):
    monkeypatch.setattr(language, "TABLE_BYTES", 40_000)
    docs = [(i, f"text of language {i % 5} " * 20, f"l{i % 5}") for i in range(40)]
    samples = language.learn(ready.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert len(samples) == 5
    assert language.Parser(samples)._table.nbytes <= 40_000
