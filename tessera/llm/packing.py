"""Best-fit decreasing packing of documents into sequences of at most N tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import Scratch, check_columns, col, to_batch
from tessera.llm.tokens import encoder

# Pieces of a group that one task packs. A group leaves one bin or so part
# empty, out of the thousands that this many pieces fill.
GROUP_ROWS = 32_768


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int,
    end_id: int | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    id_bytes: int = 0,
) -> DataFrame:
    """Cut every document's ids (then ``end_id``) into pieces of at most ``max_tokens``.

    A null text is empty; an empty document is one piece holding ``end_id``, or
    no piece where ``end_id`` is None. A null id is kept. Repeated rows give
    repeated pieces. Only the id and text columns are read, so other columns'
    names never clash. With ``id_bytes`` 2 or 4 a column ``ids`` holds the ids,
    unsigned, little-endian and that wide (the vocabulary must fit).
    """
    check_columns(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
        + ([T.StructField("ids", T.BinaryType())] if id_bytes else [])
    )
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids += tail
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part))
                    if id_bytes:
                        row = (*row, np.frombuffer(part, "<u4").astype(f"<u{id_bytes}").tobytes())
                        size += len(part)
                    rows.append(row)
                if size > 8 << 20:
                    yield to_batch(rows, arrow)
                    rows, size = [], 0
            yield to_batch(rows, arrow)

    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(cut, schema)


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that counts them.

    A leaf for every capacity holds its bins; an inner node counts the bins
    below. The tightest bin that still takes an item is the first counted leaf
    at or right of the item's length: a climb and a descent of the tree.
    """

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._bins: list[list[int]] = [[] for _ in range(self._leaves)]

    def _add(self, remaining: int, by: int) -> None:
        i, count = remaining + self._leaves, self._count
        while i:
            count[i] += by
            i >>= 1

    def put(self, remaining: int, number: int) -> None:
        if remaining:
            self._bins[remaining].append(number)
            self._add(remaining, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (remaining, bin) of the tightest bin for ``length``."""
        count, i = self._count, length + self._leaves
        if not count[i]:
            while i & 1 or not count[i + 1]:
                if i <= 1:
                    return None
                i >>= 1
            i += 1
            while i < self._leaves:
                i *= 2
                i += not count[i]
        remaining = i - self._leaves
        self._add(remaining, -1)
        return remaining, self._bins[remaining].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each of ``lengths``, which come longest first."""
    bins, offsets, opened, number = OpenBins(capacity), [], 0, []
    for length in lengths:
        found = bins.take(length)
        if found is None:
            found = capacity, opened
            opened += 1
        remaining, chosen = found
        number.append(chosen)
        offsets.append(capacity - remaining)
        bins.put(remaining - length, chosen)
    return number, offsets


def pack(pieces: DataFrame, max_tokens: int, scratch: Scratch, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces of :func:`token_pieces`.

    A full piece is a sequence by itself. The others are dealt evenly, by the
    hash of a row's number, into groups of about ``group_rows``, and each group
    is packed longest first (ties by id, piece, start); an empty input gives no
    rows. Only lengths take part: a column ``ids`` is not shuffled with them,
    so pass pieces without it and join by (doc_id, piece) where the ids are
    wanted.
    """
    saved = scratch.save(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    part = saved.filter(F.col("length") < max_tokens)
    groups = max(1, -(-part.count() // group_rows))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = pieces.columns

    def pack_group(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by(
            [("length", "descending"), *[(c, "ascending") for c in ("doc_id", "piece", "start")]]
        )
        number, offset = best_fit_decreasing(group["length"].to_pylist(), max_tokens)
        first = key[0].as_py() << 32
        return (
            group.select(names)
            .append_column("sequence_id", pa.array([first + n for n in number], pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    packed = (
        part.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
        .groupBy("__group")
        .applyInArrow(pack_group, schema)
    )
    full = saved.filter(F.col("length") >= max_tokens).select(
        *[col(f.name) for f in pieces.schema.fields],
        (-1 - F.col("__row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)


def packed_ids(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and all its ``ids`` in order.

    ``pieces`` come with ids; ids must be unique by (doc_id, piece). A sequence
    is at most ``max_tokens`` long, so each group is bounded.
    """
    placed = packed.select("doc_id", "piece", "sequence_id", "offset")
    joined = pieces.select("doc_id", "piece", "ids").withColumnsRenamed({"doc_id": "__d", "piece": "__p"})
    return (
        placed.join(joined, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("piece") == F.col("__p")))
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"))
        .select("sequence_id", F.expr("aggregate(x.ids, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"))
    )
