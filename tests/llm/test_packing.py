from __future__ import annotations

import json
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import order, packing, tokens
from tessera.llm.queries import tokenizer_path
from tessera.llm.tokens import WordEncoder
from tests.llm.conftest import odd_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(ready, library):
    texts = [r["text"] for r in ready.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += [t for _, t, _ in odd_rows()]
    texts += ["a\x01b \x01", "<|startoftext|>x y<|endoftext|>", "e\u0301 \u0301a", "²½ ª_9 don't I'LL 's", "\ufeff日 本"]
    texts += ["\u1680a\u2003b\u3000", "\x85\xa0", "\x1cab\x1d", None, "", "İ ſ ß"]
    got = WordEncoder(tokenizer_path()).encode(pa.array(texts))
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)


@pytest.mark.parametrize("limit", [1, 300, 5_000])
def test_slices_do_not_change_ids(library, monkeypatch, limit):
    monkeypatch.setattr(tokens, "SLICE_BYTES", limit)
    texts = [t for _, t, _ in odd_rows()]
    for kind in (pa.string(), pa.large_string()):
        got = WordEncoder(tokenizer_path()).encode(pa.array(["cut", *texts], kind).slice(1))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [library(t) for t in texts]
    assert list(WordEncoder(tokenizer_path()).encode(pa.array([], pa.string()))) == []


def test_encoding_takes_bounded_memory_beside_its_batch(library):
    line = "plain words of a text that many other texts hold, "
    texts = pa.array([f"{i} " + line * 200 for i in range(2_000)])
    assert texts.nbytes > 19e6
    encode = WordEncoder(tokenizer_path()).encode
    tracemalloc.start()
    try:
        for ids in encode(texts):
            pass
        assert tracemalloc.get_traced_memory()[1] < 64e6
    finally:
        tracemalloc.stop()
    assert np.frombuffer(ids, "<u4").tolist() == library(texts[-1].as_py())


def test_segment_tree_finds_the_tightest_bin():
    rng = random.Random(1)
    for capacity in (1, 7, 64, 100):
        bins, brute = packing.OpenBins(capacity), []
        for n in range(400):
            length = rng.randint(1, capacity)
            found = bins.take(length)
            fits = [r for r, _ in brute if r >= length]
            assert (found is None) == (not fits)
            if found is not None:
                assert found[0] == min(fits)
                brute.remove(found)
            remaining = rng.randint(0, capacity)
            bins.put(remaining, n)
            if remaining:
                brute.append((remaining, n))


def test_best_fit_decreasing_matches_a_scan():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 99) for _ in range(500)), reverse=True)
    bins, _ = packing.best_fit_decreasing(lengths, 100)
    left: list[int] = []
    for length in lengths:
        fits = [r for r in left if r >= length]
        if fits:
            left[left.index(min(fits))] -= length
        else:
            left.append(100 - length)
    assert max(bins) + 1 == len(left)
    filled = defaultdict(int)
    for b, n in zip(bins, lengths):
        filled[b] += n
    assert sorted(100 - v for v in filled.values()) == sorted(left)


@pytest.mark.parametrize("group_rows", [8, 32_768])
def test_packing_is_whole_and_gapless(odd, work, library, group_rows):
    pieces = packing.token_pieces(odd, tokenizer_path(), 64, 1)
    rows = packing.pack(pieces, 64, work, group_rows).collect()
    expected = []
    for doc, text, _ in odd_rows():
        ids = [*library(text), 1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected.append((str(doc), k, at, len(part), crc))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_packing_an_empty_table(empty, work):
    pieces = packing.token_pieces(empty, tokenizer_path(), 64, 1)
    assert packing.pack(pieces, 64, work).count() == 0


def test_packed_ids_round_trip(ready, work, library):
    from tests.llm.conftest import make_docs

    texts = {i: "one two three " * (i % 9) for i in range(40)}
    docs = make_docs(ready, [(i, t, "s") for i, t in texts.items()])
    pieces = packing.token_pieces(docs, tokenizer_path(), 32, 1, id_bytes=4)
    placed = packing.pack(pieces.drop("ids"), 32, work)
    sequences = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.packed_ids(pieces, placed).collect()}
    for r in placed.collect():
        ids = [*library(texts[r.doc_id]), 1]
        assert sequences[r.sequence_id][r.offset : r.offset + r.length] == ids[r.start : r.start + r.length]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_keyed_bijection(size):
    index = np.arange(size)
    a, b = order.permute(index, size, 1), order.permute(index, size, 2)
    assert sorted(a.tolist()) == index.tolist() == sorted(b.tolist())
    assert size < 64 or a.tolist() != b.tolist()
    assert order.permute(index[::-1], size, 1).tolist() == a[::-1].tolist()


def test_shards_read_back_in_slot_order(ready, odd, work, library):
    done = order.training_order(odd, tokenizer_path(), 1, 9, work, seq_len=16, shard_rows=100)
    rows = sorted(done.sequences.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert sorted(r["index"] for r in rows) == list(range(len(rows)))
    shards = {(r.shard, r.record, r.byte_offset) for r in rows}
    assert shards == {(s // 100, s % 100, s % 100 * done.stride) for s in range(len(rows))}
    read = []
    for first in range(0, len(rows), 100):
        read += order.read_slots(ready, done, first, min(100, len(rows) - first)).tolist()
    for r, ids in zip(rows, read):
        assert zlib.crc32(np.array(ids[: r.length], "<u4").tobytes()) == r.ids_crc32
        assert not any(ids[r.length :])
    # A resumed read starts anywhere in a shard.
    assert order.read_slots(ready, done, 137, 5).tolist() == read[137:142]
    # In index order the sequences are the documents end to end, whatever the partitions.
    laid = [i for r in sorted(rows, key=lambda r: r["index"]) for i in read[r.slot][: r.length]]
    whole = sorted([*library(t), 1] for _, t, _ in odd_rows())
    docs, at = [], 0
    for k, i in enumerate(laid):
        if i == 1:
            docs.append(laid[at : k + 1])
            at = k + 1
    assert sorted(docs) == whole


def test_order_of_an_empty_table(empty, work):
    assert order.training_order(empty, tokenizer_path(), 1, 9, work).sequences.count() == 0


def test_ids_that_do_not_fit_are_an_error(odd, tmp_path):
    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["id"] = 1 << 16
    (tmp_path / "big.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="do not fit"):
        order.token_sequences(odd, str(tmp_path / "big.json"), 16, 1)
