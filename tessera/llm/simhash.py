"""SimHash near-duplicates: fingerprints linked by a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.blocks import block_pairs, runs
from tessera.llm.common import Scratch, check_columns, col, components, parts_for

_SEED = 42
_BLOCK_ROWS = 8_192
_FANOUT = 8
_QUERY_ROWS = 256


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Majority bits of the shingles' XXH64; 0 where there is no word."""
    import xxhash

    # On bytes, lower() is A to Z alone and split() takes 0x20 and 0x09 to 0x0D.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle_words + 1
    if n <= 0:
        hashes = np.array([digest(joined, _SEED)], np.uint64)
    else:
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends[: n - 1]]]
        hashes = np.fromiter(
            (digest(joined[s:e], _SEED) for s, e in zip(starts, ends[shingle_words - 1 :])), np.uint64, n
        )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):  # bounded memory for very long texts
        part = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    check_columns(docs, [id_col, text_col])
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(t.as_py(), shingle_words) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(run, schema)


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the Gray sequence: its bits' prefix parities."""
    rank = fps.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Distinct fingerprints in Gray order under nodes that hold shared masked bits.

    Neighbours in Gray order share most bits. A node over some of them keeps
    the mask of bits in which all agree and those bits. A child's mask contains
    its parent's, so each level adds only the bits that it fixes anew: a search
    adds up the differing bits on the way down and leaves a whole group as
    soon as the sum passes the bound.
    """

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        values = fps.astype(np.uint64)[self.order]
        masks = np.full(len(values), ~np.uint64(0))
        levels = [(values, masks)]
        while len(values) > 1:
            first = np.arange(0, len(values), _FANOUT)
            both_one = np.bitwise_and.reduceat(values & masks, first)
            both_zero = np.bitwise_and.reduceat(~values & masks, first)
            masks = both_one | both_zero
            values = both_one
            levels.append((values, masks))
        self.levels = levels[::-1]

    def within(self, queries: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, fingerprint) places at most ``bound`` bits apart."""
        queries = queries.astype(np.uint64)
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        value, mask = self.levels[0]
        sums = np.bitwise_count((queries ^ value[0]) & mask[0]).astype(np.int64)
        known = mask
        keep = sums <= bound
        q, node, sums = q[keep], node[keep], sums[keep]
        for value, mask in self.levels[1:]:
            child = node[:, None] * _FANOUT + np.arange(_FANOUT)
            there = child < len(value)
            parent = np.broadcast_to(node[:, None], child.shape)[there]
            query = np.broadcast_to(q[:, None], child.shape)[there]
            total = np.broadcast_to(sums[:, None], child.shape)[there]
            child = child[there]
            fresh = mask[child] & ~known[parent]
            total = total + np.bitwise_count((queries[query] ^ value[child]) & fresh)
            keep = total <= bound
            q, node, sums, known = query[keep], child[keep], total[keep], mask
        return q, self.order[node]


def _search(table: pa.Table, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each unit of ``table``, as star edges to the least linked row."""
    fps = table["fp"].to_numpy().view(np.uint64)
    side = table["__side"].to_numpy()
    unit = np.zeros(len(fps), bool)
    for key in ("key", "__left", "__right"):
        values = table[key].to_numpy()
        unit[1:] |= values[1:] != values[:-1]
    starts = np.append(np.flatnonzero(np.append(True, unit[1:])), len(fps))
    a_all, b_all = [], []
    for lo, hi in zip(starts[:-1], starts[1:]):
        if hi - lo < 2:
            continue
        own, s = fps[lo:hi], side[lo:hi]
        index = GrayIndex(own)
        for at in range(0, len(own), _QUERY_ROWS):
            q, found = index.within(own[at : at + _QUERY_ROWS], bound)
            q = q + at
            take = q < found if not s.any() else (s[q] == 0) & (s[found] == 1)
            a, b = own[q[take]], own[found[take]]
            a_all.append(a)
            b_all.append(b)
    none = np.array([], np.uint64)
    return np.concatenate([none, *a_all]), np.concatenate([none, *b_all])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, root) with the components of edges (a, b): never more than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    loose = root != np.arange(len(nodes))
    return nodes[loose], nodes[root[loose]]


def links(distinct: DataFrame, bound: int) -> DataFrame:
    """Edges ``(a, b)`` that join all distinct ``fp`` at most ``bound`` bits apart.

    The 64 bits are cut into ``bound + 2`` bands. Two fingerprints within the
    bound differ in at most ``bound`` of them, so they agree wholly in two
    bands: a table for each pair of bands, dealt by those bands' bits, holds
    every link, whatever the data. Each group of equal bits is searched with
    its own index. Tables are narrow: a fingerprint and a key.
    """
    bands = bound + 2
    edges = [64 * k // bands for k in range(bands + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(bands)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    pairs = [signed(x | y) for x, y in combinations(masks, 2)]
    key = F.explode(
        F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(pairs)])
    )
    units = ["key", "__left", "__right"]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, units):
            a, b = forest(*_search(table.combine_chunks(), bound))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

    blocks = block_pairs(distinct.select("fp", key.alias("key")), "key", "fp", _BLOCK_ROWS)
    return (
        blocks.repartition(parts_for(distinct.sparkSession), *units)
        .sortWithinPartitions(*units)
        .mapInArrow(run, schema)
    )


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    shingle_words: int = 3,
    bound: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fp, component_id)``: classes of fingerprints linked within ``bound`` bits.

    Null and wordless texts have fingerprint 0 and link like any other. Equal
    fingerprints are one node however many documents have them, so copies
    never make pairs. ``component_id`` is the least id of the class; null ids
    belong to classes but never name one unless the class has no other.
    Repeated rows stay. An empty table gives no rows; no other column is read.
    """
    saved, classes = _classes(docs, scratch, shingle_words, bound, id_col, text_col)
    return saved.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(
    docs: DataFrame, scratch: Scratch, shingle_words: int, bound: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` of all rows, and ``(fp, root, component_id)`` of the distinct fingerprints."""
    saved = scratch.save(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    nodes = scratch.save(saved.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(nodes.select("fp"), bound), scratch)
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    class_ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = named.join(class_ids, "root").select(col("fp").alias("__fp"), "root", "component_id")
    classes = scratch.save(
        nodes.join(linked, F.col("fp") == F.col("__fp"), "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
        ),
        "classes",
    )
    return saved, classes


def keep_one(docs: DataFrame, scratch: Scratch, shingle_words: int = 3, bound: int = 2) -> DataFrame:
    """One row of each class, the one whose id names it, with all its columns.

    Needs ``doc_id`` and ``text``. Where several rows of a class have the least
    id, or it has null ids alone, the row of the least fingerprint, then of
    the least text and other columns, stays.
    """
    saved, classes = _classes(docs, scratch, shingle_words, bound)
    rows_of = saved.groupBy(col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    stays = (
        saved.join(classes.select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("s"))
        .select("s.doc_id", "s.fp")
    )
    names = scratch.save(
        stays.join(rows_of, F.col("doc_id").eqNullSafe(F.col("__id"))).select("__id", col("fp").alias("__fp"), "__n"),
        "names",
    )
    alone = names.filter("__n = 1 and __id is not null").select("__id")
    several = names.filter("__n > 1 or __id is null").select("__id", "__fp")

    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        fps = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(fps.view(np.int64))

    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    repeats = (
        docs.join(several.select("__id").distinct(), col("doc_id").eqNullSafe(col("__id")), "left_semi")
        .withColumn("__own", fp_of("text"))
        .join(several, col("doc_id").eqNullSafe(col("__id")) & (col("__own") == col("__fp")), "left_semi")
        .groupBy("doc_id", "__own")
        .agg(F.min(F.struct("text", *[col(c) for c in others])).alias("r"))
        .select("doc_id", "r.*")
    )
    # Texts are dealt by id at every size: one plan, whether or not the names would fit a broadcast.
    return docs.join(alone.hint("merge"), col("doc_id") == col("__id"), "left_semi").unionByName(
        repeats.select(*[col(c) for c in docs.columns])
    )


def fp_hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
