from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import blocks, collisions, simhash
from tessera.llm.common import components
from tests.llm.conftest import make_docs, odd_rows


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbBÉß \t\n\x1c ", max_size=60))
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 200), st.integers(0, 6))
def test_gray_index_finds_all(seed, n, bound):
    rng = np.random.default_rng(seed)
    fps = np.unique(rng.integers(0, 8, n, dtype=np.uint64) << np.uint64(40) | rng.integers(0, 16, n, dtype=np.uint64))
    q, found = simhash.GrayIndex(fps).within(fps, bound)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bound
    assert sorted(zip(q.tolist(), found.tolist())) == sorted(zip(*[x.tolist() for x in np.nonzero(near)]))


def test_gray_rank_orders_the_gray_sequence():
    codes = np.array([i ^ (i >> 1) for i in range(64)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def test_near_duplicates_by_brute_force(odd, work):
    rows = simhash.near_duplicates(odd, work).collect()
    want = {}
    for i, t, _ in odd_rows():
        want.setdefault(plain_fingerprint(t), []).append(i)
    roots = classes_of(sorted(want), lambda a, b: (a ^ b).bit_count() <= 2)
    names = {}
    for fp, ids in want.items():
        names.setdefault(roots[fp], []).extend(i for i in ids if i is not None)
    expected = [(str(i), fp, min(names[roots[fp]], default=None)) for fp, ids in want.items() for i in ids]
    got = [(str(r.doc_id), r.fp % 2**64, r.component_id) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_links_of_random_and_crowded_fingerprints(ready, work, monkeypatch):
    """Many fingerprints in one group: blocks of a few rows, every link within the bound."""
    monkeypatch.setattr(simhash, "_BLOCK_ROWS", 7)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    edges = simhash.links(ready.createDataFrame([(f,) for f in signed], "fp long"), 2)
    got = {r.node % 2**64: r.root % 2**64 for r in components(edges, work).collect()}
    want = classes_of(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 2)
    same = lambda m: {frozenset(n for n in fps if m.get(n, n) == r) for r in {m.get(n, n) for n in fps}}
    assert same(got) == same(want)


def test_keep_one_of_each_class(ready, odd, work):
    kept = simhash.keep_one(odd, work)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    classes = {r.component_id for r in simhash.near_duplicates(odd, work).collect()}
    assert sorted(map(str, ids)) == sorted(map(str, classes))


def test_empty_tables(ready, empty, work):
    assert simhash.near_duplicates(empty, work).count() == 0
    assert simhash.keep_one(empty, work).count() == 0
    none = ready.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert collisions.near_duplicates(none, work).count() == 0


def test_components_of_paths_stars_and_cycles(ready, work):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in components(ready.createDataFrame(edges, "a long, b long"), work).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)} | {n: 200 for n in range(200, 203)}


def test_block_pairs_cover_each_pair_once(ready):
    rows = ready.createDataFrame([(g, 1000 * g + i) for g, n in ((1, 1), (2, 5), (3, 40)) for i in range(n)], "g long, r long")
    units = {}
    for r in blocks.block_pairs(rows, "g", "r", 6).collect():
        units.setdefault((r.g, r["__left"], r["__right"]), []).append((r["__side"], r.r))
    pairs = []
    for (_, left, right), held in units.items():
        if left == right:
            own = [r for _, r in held]
            pairs += [(min(a, b), max(a, b)) for i, a in enumerate(own) for b in own[i + 1 :]]
        else:
            pairs += [(min(a, b), max(a, b)) for s, a in held for z, b in held if s == 0 and z == 1]
    want = [(1000 * g + i, 1000 * g + j) for g, n in ((2, 5), (3, 40)) for i in range(n) for j in range(i + 1, n)]
    assert sorted(pairs) == want
    assert max(map(len, units.values())) <= 24


def vectors_with_copies(rng, n, dim):
    base = rng.standard_normal((n, dim))
    near = base[: n // 4] + rng.standard_normal((n // 4, dim)) * 0.3 * rng.uniform(0, 1.4, (n // 4, 1))
    crowd = base[0] + rng.standard_normal((n // 4, dim)) * 0.12
    return np.concatenate([base, near, crowd]).astype(np.float32)


@pytest.mark.parametrize("block", [16, 4096])
def test_embeddings_against_brute_force(ready, work, monkeypatch, block):
    monkeypatch.setattr(collisions, "_BLOCK_ROWS", block)
    x = vectors_with_copies(np.random.default_rng(8), 240, 32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(900 + k, x[3].tolist(), 1) for k in range(30)]
    odd = [(950, None, 0), (951, [], 0), (952, [0.0] * 32, 0), (953, [float("nan")] + [1.0] * 31, 0)]
    odd += [(954, [None] + [1.0] * 31, 0), (955, [float("inf")] + [1.0] * 31, 0), (956, [1.0, 0.0], 0), (957, [1.0, 1e-3], 0)]
    odd += [(None, x[5].tolist(), 0)]
    table = ready.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: r for r in collisions.near_duplicates(table, work).collect()}
    assert len(got) == len(rows) + len(odd)
    ids = [r[0] for r in rows]
    y = np.array([r[1] for r in rows], np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    links = near.sum(axis=1)
    links[near[:, 5]] += 1  # the row with a null id is a copy of row 5
    links[5] += 1
    found = np.array([got[i].n_links for i in ids])
    assert (found <= links).all()
    assert found.sum() >= 0.95 * links.sum()
    roots = classes_of(list(range(len(ids))), lambda a, b: near[a, b])
    agree = np.mean([got[i].component_id == ids[roots[k]] for k, i in enumerate(ids)])
    assert agree >= 0.95
    for i in range(950, 956):
        assert (got[i].n_links, got[i].component_id) == (0, i)
    assert (got[956].n_links, got[957].component_id) == (1, 956)
    assert got[None].n_links == got[5].n_links


def test_calibrated_recall_at_the_bound():
    """Pairs exactly at the bound are found as often as the plan says."""
    rng = np.random.default_rng(2)
    for rows in (1_000, 1_000_000):
        plan = collisions.calibrate(rows, 0.95)
        a = collisions.unit_rows(rng.standard_normal((400, 64)))
        other = rng.standard_normal((400, 64))
        other -= (other * a).sum(axis=1, keepdims=True) * a
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * collisions.unit_rows(other)
        (va, ca), (vb, cb) = collisions._project(a, plan, 5), collisions._project(b, plan, 5)
        hit = (ca == cb).any(axis=1) & ((np.abs(va - vb) <= plan.half_width).sum(axis=1) >= plan.least)
        assert hit.mean() >= 0.95


def _compared(cells):
    """Pairs in cells, those of several groups counted in each."""
    counts = [np.unique(c, return_counts=True)[1] for c in cells.T]
    return sum(int((n * (n - 1) // 2).sum()) for n in counts)


def test_clouds_with_a_common_direction():
    """Unrelated vectors at a mean cosine of 0.8: cells stay small, and pairs at the bound are found."""
    rng = np.random.default_rng(8)
    # The share of all pairs that a table of a million such vectors compares, measured on some of them.
    n, dim = 2_000, 64
    common = collisions.unit_rows(rng.standard_normal((1, dim)))
    own = collisions.unit_rows(rng.standard_normal((n, dim)))
    a = collisions.unit_rows(np.sqrt(0.8) * common + np.sqrt(0.2) * own)
    shares = collisions.background(list(a[: collisions.SAMPLE]), 0.95)
    assert sum(share for _, share in shares) == pytest.approx(1)
    assert sum(c * share for c, share in shares) == pytest.approx(0.8, abs=0.03)
    plain, fitted = collisions.calibrate(10**6, 0.95), collisions.calibrate(10**6, 0.95, shares)
    pairs = n * (n - 1) / 2
    assert _compared(collisions._project(a, fitted, 5)[1]) < 0.05 * pairs
    assert _compared(collisions._project(a, plain, 5)[1]) > 0.2 * pairs
    other = rng.standard_normal((400, dim))
    other -= (other * a[:400]).sum(axis=1, keepdims=True) * a[:400]
    b = 0.951 * a[:400] + np.sqrt(1 - 0.951**2) * collisions.unit_rows(other)
    (va, ca), (vb, cb) = collisions._project(a[:400], fitted, 5), collisions._project(b, fitted, 5)
    hit = (ca == cb).any(axis=1) & ((np.abs(va - vb) <= fitted.half_width).sum(axis=1) >= fitted.least)
    assert hit.mean() >= 0.95


def test_background_of_nothing():
    assert collisions.background([], 0.95) == [(0.0, 1.0)]
    assert collisions.background([np.ones(3), np.ones(4), np.ones(3)], 0.95) == [(0.0, 1.0)]


def test_links_in_a_cloud_by_brute_force(ready, work):
    rng = np.random.default_rng(4)
    own = collisions.unit_rows(rng.standard_normal((900, 24)))
    own[600:] = collisions.unit_rows(own[:300] + 0.12 * rng.standard_normal((300, 24)))
    x = collisions.unit_rows(np.sqrt(0.7) * np.eye(24)[0] + np.sqrt(0.3) * own)
    near = x @ x.T >= 0.95
    want = near.sum(axis=1) - 1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in collisions.near_duplicates(df, work).collect()}
    links = np.array([got[i] for i in range(900)])
    assert (links <= want).all() and links.sum() >= 0.95 * want.sum() and want.sum() >= 300


def test_near_copies_share_a_class(ready, work):
    rng = random.Random(6)
    text = " ".join(f"w{rng.randint(0, 999)}" for _ in range(400))
    docs = make_docs(ready, [(1, text, "a"), (2, text.upper(), "a"), (3, text + " tail", "a"), (4, "other " * 9, "a")])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, work).collect()}
    assert got[2] == 1 and got[4] == 4


def test_calibration_of_very_many_rows():
    plans = [collisions.calibrate(10**k, 0.95) for k in (3, 6, 9, 11, 13)]
    assert all(a.directions < b.directions for a, b in zip(plans, plans[1:]))
    assert all(0 < p.least < p.directions for p in plans)


def test_one_row_of_each_class_stays_whatever_its_ids(ready, work):
    """Near copies that share the naming id, or have null ids alone, are one class like any other."""
    rng = random.Random(9)
    base = [rng.choice("ab") + str(rng.randrange(10**6)) for _ in range(400)]
    prints, texts = {}, []
    for k in range(400):
        words = list(base)
        words[k] = "other"
        text = " ".join(words)
        fp = plain_fingerprint(text)
        if fp not in prints and all((fp ^ x).bit_count() <= 2 for x in prints):
            prints[fp] = text
    texts = [prints[x] for x in sorted(prints)]
    assert len(texts) >= 3
    for ids in ([7, 7, 7], [None, None, None], [7, None, 7], [8, 7, 7]):
        rows = list(zip(ids, texts, "sss")) + [(ids[0], texts[0], "s"), (7, "quite another text of seven words here", "s")]
        docs = make_docs(ready, rows)
        kept = simhash.keep_one(docs, work)
        got = kept.collect()
        assert kept.columns == docs.columns and len(got) == 2
        of_class = [r.doc_id for r in got if r.text in texts]
        assert of_class == [min((i for i in ids if i is not None), default=None)]
