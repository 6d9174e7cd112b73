from __future__ import annotations

import bisect
import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tessera.llm import alignment
from tessera.llm.queries import ALIGNED, QUERIES, tokenizer_path
from tests.llm.conftest import make_docs, odd_rows

PATHS = [tokenizer_path(name) for name in ALIGNED]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in own}
    byte_of |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}

    def bytes_a(i):
        return bytes(byte_of[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), bytes_a, b.encode, bytes_b


def _spans(ids, bytes_of):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(bytes_of(i))))
        at = out[-1][2]
    return out


def brute(libraries, texts):
    """Every pair of tokens compared; groups cut at the ends that both have."""
    encode_a, bytes_a, encode_b, bytes_b = libraries
    docs = []
    for t in texts:
        a, b = ([], []) if not t else (encode_a(t), encode_b(t))
        raw = (" " + (t or "")).encode()
        if not t or b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
            docs.append(([], [], [], []))
            continue
        sa, sb = _spans(a, bytes_a), _spans(b, bytes_b)
        links, first = [], 0
        for i, x, y in sa:
            while sb[first][2] <= x:
                first += 1
            k = first
            while k < len(sb) and sb[k][1] < y:
                links.append((i, sb[k][0]))
                k += 1
        common = sorted({y for _, _, y in sa} & {v for _, _, v in sb})
        groups = [([], []) for _ in common]
        for side, tokens in enumerate((sa, sb)):
            for i, _, end in tokens:
                groups[bisect.bisect_left(common, end)][side].append(i)
        docs.append((a, b, links, groups))
    count = Counter(p for d in docs for p in d[2])
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    rows = []
    for a, b, links, groups in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (
                len(a), len(b), len(groups), len(links),
                sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return rows


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1000])
def test_merge_by_pieces_is_the_merge(piece):
    rng = random.Random(piece)
    for size in (1, 2, 5, 40, 300):
        for _ in range(8):
            a = sorted({size, *(rng.randint(1, size) for _ in range(rng.randint(0, size)))})
            b = sorted({size, *(rng.randint(1, size) for _ in range(rng.randint(0, size)))})
            la, lb, ga, gb = alignment.merge(np.array(a), np.array(b), piece)
            spans_a, spans_b = list(zip([0, *a], a)), list(zip([0, *b], b))
            want = [
                (i, j) for i, (x, y) in enumerate(spans_a) for j, (u, v) in enumerate(spans_b) if max(x, u) < min(y, v)
            ]
            assert list(zip(la.tolist(), lb.tolist())) == want
            common = sorted(set(a) & set(b))
            assert ga.tolist() == [a.index(c) + 1 for c in common]
            assert gb.tolist() == [b.index(c) + 1 for c in common]


def test_pieces_are_equal_work():
    a, b = np.arange(1, 10_001), np.array([10_000])
    cuts = alignment.diagonal(a, b, np.arange(0, 10_001, 100))
    assert (np.diff(cuts) >= 99).all()


def test_plain_texts_encode_as_the_library(libraries):
    """Every code point that takes the quick way, between letters, digits, marks and spaces."""
    points = [chr(c) for c in [*range(0x528), *range(0x2000, 0x2070)]]
    texts = [f" {p}{p}a{p}1{p}.{p} {p}  {p}'s{p}" for p in points] + [" " + "".join(points)]
    assert not any(map(alignment._NEWER, texts))
    pairs = alignment.BytePairs(PATHS[0])
    assert pairs.encode(texts) == [libraries[0](t[1:]) for t in texts]


def test_alignment_matches_brute_force(ready, libraries, tmp_path):
    rows = odd_rows() + [
        (70, "a▁b", "s"), (71, "<s> </s> <unk> <0x41> <|endoftext|>", "s"), (72, "\x00 x\ty\n\n z  ", "s"),
        (73, "日本語 \U0001f600 กิ Ა", None), (74, " ", "s"), (75, "x" * 3000, "s"),
    ]
    make_docs(ready, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_token_alignment"](ready, str(tmp_path)).collect()
    want = [(i, *r) for (i, _, _), r in zip(rows, brute(libraries, [t for _, t, _ in rows]))]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], *[r[n] for n in NAMES])) for r in got)


@pytest.mark.parametrize("limit", [1, 4000])
def test_block_size_does_not_change_results(ready, libraries, monkeypatch, tmp_path, limit):
    # Workers import the module anew, so blocks are made small by calling the aligner here.
    texts = [t for _, t, _ in odd_rows()]
    aligner = alignment.Aligner(*PATHS)
    whole = [r[:5] for r in aligner.block(texts)[0]]
    cut = [r[:5] for k in range(0, len(texts), limit) for r in aligner.block(texts[k : k + limit])[0]]
    assert whole == cut


@pytest.mark.parametrize("limit", [1, 500, 4000])
def test_slices_do_not_change_a_block(libraries, limit):
    texts = [t for _, t, _ in odd_rows()]
    aligner = alignment.Aligner(*PATHS)
    (rows, pairs, counts), (cut, cut_pairs, cut_counts) = aligner.block(texts), aligner.block(texts, limit)
    assert rows == cut and pairs.tolist() == cut_pairs.tolist() and counts.tolist() == cut_counts.tolist()
    assert [len(r) for r in aligner.block([])] == [0, 0, 0]


def test_a_block_takes_little_memory():
    """Tokens and merge steps are held for a slice, not for the block: 111 bytes a byte of text before."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(600)]
    aligner = alignment.Aligner(*PATHS)
    aligner.block(texts[:5])
    tracemalloc.start()
    aligner.block(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * sum(map(len, texts))


def test_whole_small_table(ready, libraries):
    docs = ready.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op11_token_alignment"](ready, SF).collect()}
    assert got == {d["doc_id"]: r for d, r in zip(docs, brute(libraries, [d["text"] for d in docs]))}


def test_empty_table(ready, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op11_token_alignment"](ready, str(tmp_path))
    assert out.count() == 0 and set(out.columns) == {"doc_id", *NAMES}
