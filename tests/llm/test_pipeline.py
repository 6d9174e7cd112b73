from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import common, packing, quality, queries, templates
from tests.llm.test_deal import targets_by_rounds
from tests.llm.test_near import classes_of, plain_fingerprint
from tests.llm.test_text import plain_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(ready):
    """Each stage's result, written and read again, with the documents first."""
    from tessera.llm.common import Scratch

    work = Scratch(ready, "stages")
    docs = queries.table(ready, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = work.save(stage(ready, docs, SF), name.replace(" ", "_"))
        out.append(docs)
    return out


def rows_of(df):
    return sorted((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_stages_keep_the_columns(stages):
    for out in stages[1:-1]:
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.dtypes == stages[0].dtypes


def test_rejected_documents_go(ready, stages):
    model = quality.fit(stages[0], queries.table(ready, SF, "labels"))
    want = [r for r in rows_of(stages[0]) if model.score(r[1]) >= queries.QUALITY_THRESHOLD]
    assert 0 < len(want) < stages[0].count()
    assert rows_of(stages[1]) == want


def test_recurring_lines_go(stages):
    rows = rows_of(stages[1])
    rules = templates.Rules()
    path, find, holders = plain_dedup([(r[0], r[1], r[3]) for r in rows], rules)
    want = []
    for i, text, lang, source, n in rows:
        kept = []
        for line in text.split("\n"):
            p = path(line)
            held = holders[find(p)] if p else ()
            if p is None or len(held) < rules.min_docs or i == min(h for h, _ in held):
                kept.append(line)
        new = "\n".join(kept)
        want.append((i, new, lang, source, len(new) if new != text else n))
    assert rows_of(stages[2]) == want != rows


def test_one_of_each_near_duplicate_group_stays(stages):
    rows = rows_of(stages[2])
    least = {}
    for r in rows:
        least.setdefault(plain_fingerprint(r[1]), r[0])
    roots = classes_of(sorted(least), lambda a, b: (a ^ b).bit_count() <= queries.SIMHASH_BITS)
    names = defaultdict(list)
    for fp, i in least.items():
        names[roots[fp]].append(i)
    stay = {min(ids) for ids in names.values()}
    assert rows_of(stages[3]) == [r for r in rows if r[0] in stay]
    assert len(stay) < len(rows)


def test_the_mix_by_definition(stages):
    rows = rows_of(stages[3])
    words = lambda t: len([w for w in t.replace("\x0b", " ").split() if w])
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    targets = targets_by_rounds(sizes)
    want = []
    for r in rows:
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0.0
        draw = int(hashlib.md5(f"7:{r[0]}:{r[1]}".encode()).hexdigest()[:13], 16) / 2**52
        want += [r] * (int(rate) + (draw < rate - int(rate)))
    assert rows_of(stages[4]) == sorted(want)


def test_packing_by_definition(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    lengths, pieces = [], Counter()
    for r in stages[4].collect():
        n = len(tok.encode(r.text, add_special_tokens=False).ids) + 1
        for k, at in enumerate(range(0, n, queries.MAX_TOKENS)):
            length = min(queries.MAX_TOKENS, n - at)
            pieces[(r.doc_id, k, at, length)] += 1
            lengths.append(length)
    packed = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in packed) == pieces
    bins, _ = packing.best_fit_decreasing(sorted(lengths, reverse=True), queries.MAX_TOKENS)
    assert len({r.sequence_id for r in packed}) == len(set(bins))
    filled = np.zeros(len(packed))
    for k, s in enumerate({r.sequence_id for r in packed}):
        filled[k] = sum(r.length for r in packed if r.sequence_id == s)
    assert filled.max() <= queries.MAX_TOKENS


def test_run_gives_the_packed_pieces(ready, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(ready, SF)) == key(stages[5])


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


def test_tables_of_a_finished_stage_are_deleted(ready):
    with common.temporary():
        scratch = common.Scratch(ready, "stage")
        scratch.save(ready.range(3), "t")
        assert os.path.exists(scratch.path.removeprefix("file:"))
    assert not os.path.exists(scratch.path.removeprefix("file:"))
    kept = common.Scratch(ready, "kept")
    assert kept.save(ready.range(2), "t").count() == 2
