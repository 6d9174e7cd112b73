from __future__ import annotations

import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, sharding
from tests.compare import compare, duck_connection
from tests.llm.conftest import make_docs, odd_rows


def checked(rows, got, shards):
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    held = defaultdict(int)
    for r in got:
        held[r.shard] += r["size"]
    return held


def test_every_row_has_one_place(odd, empty, work):
    checked(odd_rows(), sharding.shard_by_bytes(odd, work, 4).collect(), 4)
    assert sharding.shard_by_bytes(empty, work, 4).count() == 0


def test_shards_are_even_with_a_hot_text(ready, work):
    """A third of all rows is one text: its range is subdivided, others keep equal texts together."""
    rows = [(i, "hot text that many documents hold", "s") for i in range(1000)]
    rows += [(1000 + i, f"text {i % 900} " * (1 + i % 7), "s") for i in range(2000)]
    got = sharding.shard_by_bytes(make_docs(ready, rows).repartition(5), work, 8).collect()
    held = checked(rows, got, 8)
    mean = sum(held.values()) / 8
    assert max(held.values()) <= 1.03 * mean and min(held.values()) >= 0.97 * mean
    homes = defaultdict(set)
    for r in got:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in homes.values()) == 1


def test_ranges_are_even_in_rows_too(ready, work):
    """Empty and null texts weigh next to nothing, but no task gets a third of all rows."""
    rows = [(i if i % 3 else None, "" if i % 2 else None, "s") for i in range(3000)]
    rows += [(3000 + i, f"text {i} " * 20, "s") for i in range(3000)]
    docs = make_docs(ready, rows).repartition(5)
    checked(rows, sharding.shard_by_bytes(docs, work, 4).collect(), 4)
    keys = docs.select(
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.monotonically_increasing_id().alias("place"),
    )
    saved = work.save(keys, "keys")
    total = saved.agg(F.sum("size")).first()[0]
    _, held = sharding._even_ranges(saved, total, 6000, 64, 11)
    assert held["rows"].sum() == 6000 and held["bytes"].sum() == total
    assert held["rows"].max() <= 2 * 6000 / 64 and held["bytes"].max() <= 2 * total / 64


def test_written_shards_hold_whole_rows(ready, work):
    rows = [(i, f"text {i} " * (i % 5), "s") for i in range(200)]
    docs = make_docs(ready, rows)
    placed = sharding.shard_by_bytes(docs, work, 3)
    path = work.place("out")
    sharding.write_shards(docs, placed, path)
    want = {r.doc_id: (r.shard, r.slot) for r in placed.collect()}
    back = ready.read.parquet(path)
    assert {r.doc_id: (r.shard, r.slot) for r in back.collect()} == want
    assert set(docs.columns) <= set(back.columns)


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > most * sizes[s] + 1e-9]
        if not full:
            return target | {s: left * w[s] / total for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            open_.discard(s)
        left -= sum(target[s] for s in full)
    return target


def test_targets_and_copies(odd, empty, work):
    rows = mixing.mix(odd, work).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in odd_rows():
        sizes[s] += count(t)
    want = targets_by_rounds(sizes)
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["__size"] == count(r.text) and r["__source_size"] == sizes[r.source]
        assert r["__target"] == pytest.approx(want[r.source])
        rate = r["__target"] / r["__source_size"] if r["__source_size"] else 0
        assert int(rate) <= r["__copies"] <= min(2, int(rate) + 1)
    again = mixing.mix(odd, work).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix(empty, work).count() == 0
    repeated = mixing.repeated(mixing.mix(odd, work), odd.columns)
    assert repeated.columns == odd.columns
    assert repeated.count() == sum(r["__copies"] for r in rows)


def test_taken_comes_near_the_target(ready, work):
    rows = [(i, "word " * (1 + i % 40), f"s{i % 5}") for i in range(4000)]
    got = mixing.mix(make_docs(ready, rows), work).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r["__copies"] * r["__size"]
        target[r.source] = r["__target"]
    for s, n in taken.items():
        assert n == pytest.approx(target[s], rel=0.1)


def test_mixing_matches_its_sql(ready):
    from tessera.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    out = compare(QUERIES["op7_source_mixing"](ready, sf), ORACLE_SQL["op7_source_mixing"], duck_connection(sf))
    assert out["values_match"] and out["spark_rows"] == out["oracle_rows"]
