from __future__ import annotations

import random
import re
import zlib

import pytest

from tessera.llm import quality, templates
from tests.llm.conftest import make_docs, odd_rows


def plain_dedup(rows, rules):
    """The definition: fields, literal lines, templates by (tokens, leading tokens), merged by single links."""

    def path(line):
        tokens = [t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t]
        if len(tokens) < rules.min_tokens:
            return None
        fields = [re.search("[0-9]", t) is not None for t in tokens]
        literal = sum(fields) > len(tokens) * (1 - rules.constant)
        key = tokens if literal else ["<*>" if f else t for t, f in zip(tokens, fields)]
        return literal, tuple(key)

    def one(a, b):
        if a[0] or b[0] or len(a[1]) != len(b[1]) or a[1][: rules.depth] != b[1][: rules.depth]:
            return False
        pairs = [(x, y) for x, y in zip(a[1], b[1]) if not x == y == "<*>"]
        return sum(x == y for x, y in pairs) >= rules.similarity * len(pairs)

    docs = sorted({(i, t) for i, t, _ in rows if t is not None}, key=str)
    found = sorted({p for _, t in docs for p in map(path, t.split("\n")) if p})
    root = {p: p for p in found}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(found):
        for b in found[k + 1 :]:
            if one(a, b):
                root[find(a)] = find(b)
    holders = {}
    for d in docs:
        for line in d[1].split("\n"):
            if path(line):
                holders.setdefault(find(path(line)), set()).add(d)
    return path, find, holders


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(7)
    words = "ant bee cow dog elk fox gnu hen ibis jay".split()
    prose = lambda n: " ".join(rng.choice(words) + rng.choice("aeiou") for _ in range(n))
    shared = [prose(60), prose(12), "Page 3 of 10 was printed on Monday", prose(4)]
    rows = []
    for i in range(30):
        text = [prose(rng.randint(3, 30)) for _ in range(6)]
        if i % 3 == 0:
            text.insert(2, shared[0])
        if i % 4 == 0:
            words12 = shared[1].split()
            words12[7] = f"variant{'xyz'[i % 3]}"
            text.append(" ".join(words12))
        if i % 5 == 0:
            text.append(f"Page {i} of {i + 7} was printed on Monday")
        text.append(shared[3])
        rows.append((i, "\n".join(text), f"s{i % 2}"))
    return rows + [(40, rows[1][1], "s0"), (41, None, "s0"), (42, "", None), (None, rows[3][1], "s1")]


@pytest.fixture(scope="module")
def dense():
    """Leaves with many templates near the bound: few words, fields, rows of numbers, a line most have."""
    rng = random.Random(11)
    lead = ["at the end", "by a 7", "1 2 so"]

    def line():
        rest = [rng.choice(["up", "up", "up", "off", "in", str(rng.randrange(4))]) for _ in range(rng.randint(1, 14))]
        return rng.choice(lead) + " " + " ".join(rest)

    rows = [(i, "\n".join(line() for _ in range(8)), "s") for i in range(40)]
    return [(i, t + "\nmost have this line" * (i % 3 > 0), s) for i, t, s in rows]


def test_dense_fixture_has_both_kinds(dense):
    """Literal lines and lines that only count fields apart tell from one another are in it."""
    path, find, _ = plain_dedup(dense, templates.Rules())
    paths = {path(x) for _, t, _ in dense for x in t.split("\n")}
    assert any(literal for literal, _ in paths) and len({find(p) for p in paths}) < len(paths)
    width = lambda p: (len(p[1]), p[1][:3])
    raw = lambda a, b: sum(x == y for x, y in zip(a[1], b[1])) >= 0.8 * len(a[1])
    loose = [p for p in paths if not p[0]]
    assert any(raw(a, b) and width(a) == width(b) and find(a) != find(b) for a in loose for b in loose)


@pytest.mark.parametrize("hot", [1_024, 4])
@pytest.mark.parametrize("similarity", [0.8, 0.5])
def test_segments_lose_no_template(ready, work, dense, monkeypatch, hot, similarity):
    monkeypatch.setattr(templates, "_HOT_CLASSES", hot)
    monkeypatch.setattr(templates, "_BLOCK_ROWS", 16)
    rules = templates.Rules(similarity=similarity)
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(make_docs(ready, dense), work, rules).collect()}
    path, find, holders = plain_dedup(dense, rules)
    first = {c: min(i for i, _ in d) for c, d in holders.items()}
    for i, text, _ in dense:
        assert got[i] == "\n".join(x for x in text.split("\n") if first[find(path(x))] == i)


@pytest.mark.parametrize("block", [2, 2_048])
def test_recurring_lines_by_definition(ready, work, lines, monkeypatch, block):
    monkeypatch.setattr(templates, "_BLOCK_ROWS", block)
    rules = templates.Rules()
    docs = make_docs(ready, lines + [lines[2]])
    out = templates.drop_recurring_lines(docs, work, rules)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    got = {r.doc_id: (r.text, r.n_dropped) for r in out.collect()}
    assert out.count() == len(lines) + 1
    path, find, holders = plain_dedup(lines, rules)
    kept_in = {}
    for doc, text, _ in lines:
        for line in (text or "").split("\n"):
            p = path(line)
            if p is None or len(holders[find(p)]) < rules.min_docs:
                assert text is None or line in got[doc][0].split("\n")
            elif line in got[doc][0].split("\n"):
                kept_in.setdefault(find(p), set()).add(doc)
    # Every recurring template stays in one document, the one with the least id (null first).
    recurring = {c for c, d in holders.items() if len(d) >= rules.min_docs}
    assert set(kept_in) == recurring
    for c, docs_left in kept_in.items():
        ids = {i for i, _ in holders[c]}
        assert docs_left == {None if None in ids else min(ids)}
    assert got[41] == (None, 0) and got[42] == ("", 0)


def test_odd_and_empty_tables(odd, empty, work):
    out = templates.drop_recurring_lines(odd, work)
    assert out.count() == len(odd_rows())
    assert templates.drop_recurring_lines(empty, work).count() == 0


def labelled(spark, n=300):
    rng = random.Random(5)
    good = "the quick brown fox jumps over a lazy dog and runs home again".split()
    bad = "BUY!! NOW!! FREE$$ click|here|win $$$ ### CHEAP!! pills|pills".split()
    rows, labels = [], []
    for i in range(n):
        q = int(i % 4 > 0)
        text = " ".join(rng.choice(good if q else bad) for _ in range(rng.randint(20, 200)))
        rows.append((i, text, "s"))
        labels.append((i, q, 0))
    return rows, labels


def test_held_out_accuracy_and_purity(ready):
    rows, labels = labelled(ready)
    rows += [(1000, "", "s"), (1001, None, "s"), (None, "the quick dog", "s"), (1, rows[1][1], "s")]
    schema = "doc_id long, quality int, toxic int"
    table = ready.createDataFrame(labels + [(None, 1, 0), (5, None, 0)], schema)
    docs = make_docs(ready, rows)
    model = quality.fit(docs, table)
    out = docs.withColumn("score", model.score_column(docs["text"])).select(
        "doc_id", "score", quality.held_out().alias("held_out")
    )
    got = out.collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels}
    test = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 for r in got)
    # Held-out labels decide nothing: turned round, the model is the same.
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    again = quality.fit(docs, ready.createDataFrame(turned, schema))
    assert again == model


def test_models_without_enough_labels(ready, empty):
    schema = "doc_id long, quality int, toxic int"
    rows, labels = labelled(ready, 40)
    docs = make_docs(ready, rows)
    one = quality.fit(docs, ready.createDataFrame([x for x in labels if x[1] == 1], schema))
    assert one.score("any text") > 0.9
    none = quality.fit(docs, ready.createDataFrame([], schema))
    assert none.score("any text") == pytest.approx(0.5) == none.score(None)
    assert quality.fit(empty, ready.createDataFrame(labels, schema)).score("") == pytest.approx(0.5)
    few = quality.fit(docs, ready.createDataFrame(labels[:12], schema))
    assert 0 <= few.score(rows[0][1]) <= 1


def test_sample_bounds_hold(ready):
    rows, labels = labelled(ready)
    docs, table = make_docs(ready, rows), ready.createDataFrame(labels, "doc_id long, quality int, toxic int")
    small = quality.fit(docs, table, quality.Sample(10, 20, 4_000, 2_048))
    assert len(small.good) <= 2_048 and len(small.bad) <= 2_048


def test_repeated_ids_and_long_texts_of_the_sample(ready):
    """One id on many rows counts once; a text above the bound silences no other."""
    rows, labels = labelled(ready)
    table = ready.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = quality.Sample(40, 80, 200_000, 4_096)
    model = quality.fit(make_docs(ready, rows), table, sample)
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    again = [(held[0], rows[held[0]][1] + " more" * k, "s") for k in range(3_000)]
    assert quality.fit(make_docs(ready, rows + again), table, sample) == model
    # Every id but the last few gets a long text as well; the short one is learnt from.
    long = [(i, "x " * 150_000, "s") for i in held[:5]]
    assert quality.fit(make_docs(ready, rows + long), table, sample) == model
    more = ready.createDataFrame(labels + [(1000 + k, k % 2, 0) for k in range(40)], table.schema)
    only = [(1000 + k, "x " * 150_000, "s") for k in range(40)]
    assert quality.fit(make_docs(ready, rows + only), more, sample) == model


def test_scores_by_definition(ready):
    """Every score from zstandard alone: sizes of 512-byte parts with either dictionary."""
    import math

    import zstandard

    rows, labels = labelled(ready)
    rows += [(900, "", "s"), (901, None, "s"), (902, "é日本 " * 3_000, "s")]
    docs = make_docs(ready, rows)
    model = quality.fit(docs, ready.createDataFrame(labels, "doc_id long, quality int, toxic int"))

    def size(raw, words):
        packer = zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(words), write_content_size=False, write_dict_id=False)
        return sum(len(packer.compress(raw[at : at + 512])) for at in range(0, len(raw), 512))

    for r in docs.select("text", model.score_column(docs["text"]).alias("score")).collect():
        raw = (r.text or "").encode()
        good, bad = size(raw, model.good), size(raw, model.bad)
        z = model.intercept + model.slope * ((bad - good) / (bad + good) if raw else 0)
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-50, min(50, z)))), abs=1e-12)


def test_short_lines_recur_like_long_ones(ready, work):
    rows = [(i, f"All rights reserved.\n\nOnly of {'abcdef'[i]} here\nEnd", "s") for i in range(6)]
    out = templates.drop_recurring_lines(make_docs(ready, rows + [(6, "End\nfree text", "s")]), work)
    got = {r.doc_id: (r.text, r.n_dropped) for r in out.collect()}
    assert got[0] == (rows[0][1], 0)
    # Blank lines and lines of one document stay.
    assert all(got[i] == (f"\nOnly of {'abcdef'[i]} here", 2) for i in range(1, 6))
    assert got[6] == ("free text", 1)


@pytest.mark.parametrize("block", [2, 2_048])
def test_rows_of_numbers_are_no_passage(ready, work, monkeypatch, block):
    monkeypatch.setattr(templates, "_BLOCK_ROWS", block)
    rows = [
        (0, "2019 12.5 13.1 14.0 15.2\n1 2 3 4 5 6 7 8 9 10\nRain 3 4 5 6 7\n1 2 3\nPage 3 of 10", "s"),
        (1, "2020 11.5 10.1 19.0 12.2\n1 2 3 4 5 6 7 8 9 11\nRain 8 4 5 6 7\n4 5 6\nPage 4 of 10", "s"),
        # A row that stands in both goes from one; fields alone are no agreement.
        (2, "1 2 3 4 5 6 7 8 9 10\n1 a1 2 b2 north south east west", "s"),
        (3, "2 a2 3 b3 north south left right\n2 a2 3 b3 up down left right", "s"),
    ]
    out = templates.drop_recurring_lines(make_docs(ready, rows), work)
    got = {r.doc_id: (r.text, r.n_dropped) for r in out.collect()}
    assert got[0] == (rows[0][1], 0)
    assert got[1] == (rows[1][1].removesuffix("\nPage 4 of 10"), 1)
    assert got[2] == ("1 a1 2 b2 north south east west", 1)
    assert got[3] == (rows[3][1], 0)
    # Equal but for one constant of ten, fields aside: one template.
    like = [(i, f"At {i} o'clock the {w} went out to see that they were well", "s") for i, w in enumerate(["dog", "cat"])]
    out = templates.drop_recurring_lines(make_docs(ready, like), work)
    assert sorted(r.n_dropped for r in out.collect()) == [0, 1]
