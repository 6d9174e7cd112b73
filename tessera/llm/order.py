"""Training-order materialisation: every sequence gets a global slot in fixed-stride shards.

A slot is a keyed permutation of the sequence's index: a Feistel network over
the least even number of bits that holds all indexes, walked along its cycle
until the result is below the number of sequences. The permutation needs no
sort and no state, so any slot can be found again from the key alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import Scratch, check_columns, col, dense_index, parts_for, row_position, to_batch
from tessera.llm.tokens import encoder, vocabulary_size

# Two bytes hold an id of the vocabularies used here. A record ends with one
# id 0 that belongs to no document, so records stay aligned to whole ids.
ID_BYTES = 2
RECORD_END = "\0\0"
_ROUNDS = 6


def permute(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Keyed bijection of 0 .. size-1, for an array of indexes in that range."""
    half = np.uint64(max(1, (max(1, size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(key).integers(0, 2**64, _ROUNDS, dtype=np.uint64)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Order:
    """Where the shards are, and one row for each sequence with its place there."""

    path: str
    seq_len: int
    shard_rows: int
    sequences: DataFrame

    @property
    def stride(self) -> int:
        return ID_BYTES * self.seq_len + len(RECORD_END)


def token_sequences(
    docs: DataFrame, tokenizer: str, seq_len: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut the ids of documents, laid end to end, into sequences of ``seq_len``.

    Each document's ids are followed by ``end_id``; only the last sequence of a
    task may be shorter. ``doc_ids`` lists the documents that a sequence has
    ids of and ``start`` says how many of the first one's ids came before it.
    ``body`` holds the ids, compressed: it is written and shuffled once each.
    A vocabulary whose ids do not fit in ``ID_BYTES`` is an error.
    """
    check_columns(docs, [id_col, text_col])
    if max(vocabulary_size(tokenizer), end_id + 1) > 1 << 8 * ID_BYTES:
        raise ValueError(f"ids of {tokenizer} do not fit in {ID_BYTES} bytes")
    schema = T.StructType(
        [
            T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("body", T.BinaryType()),
        ]
    )
    tail = int(end_id).to_bytes(4, "little")
    full = 4 * seq_len

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        arrow = to_arrow_schema(schema)
        encode = encoder(tokenizer).encode

        def sequence() -> tuple:
            raw = bytes(open_ids[:full])
            body = pack(np.frombuffer(raw, "<u4").astype(f"<u{ID_BYTES}").tobytes())
            return list(open_docs), start, len(raw) // 4, zlib.crc32(raw), body

        open_ids, open_docs, start = bytearray(), [], 0
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids += tail
                used = 0
                while used < len(ids):
                    if not open_ids:
                        start = used // 4
                    open_docs.append(doc)
                    room = full - len(open_ids)
                    open_ids += ids[used : used + room]
                    used += room
                    if len(open_ids) == full:
                        rows.append(sequence())
                        open_ids.clear()
                        open_docs.clear()
                if len(rows) >= 1024:
                    yield to_batch(rows, arrow)
                    rows = []
            yield to_batch(rows, arrow)
        if open_ids:
            yield to_batch([sequence()], arrow)

    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(cut, schema)


def training_order(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    key: int,
    scratch: Scratch,
    seq_len: int = 4096,
    shard_rows: int = 8_192,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Order:
    """Tokenise, permute and write all sequences; ``Order.sequences`` lists them.

    Sequences are those of :func:`token_sequences`, short ones padded with id
    0 to the stride. Indexes follow the sequence table, which is written once;
    slots are 0 .. n-1 without gaps. Shard ``s`` is the folder ``shard=s`` with
    one file of ``shard_rows`` records (the last shard may be shorter), in slot
    order, so a reader resumes at ``(slot % shard_rows) * stride``. Null texts
    are empty, an empty text is one ``end_id``, repeated rows come each, null
    ids stay, an empty table writes no shard, and other columns are not read.
    """
    spark = docs.sparkSession
    pieces = token_sequences(docs, tokenizer, seq_len, end_id, id_col, text_col)
    saved = scratch.save(pieces.withColumn("__row", row_position()), "sequences")
    size = saved.count()

    @F.pandas_udf("long")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(permute(index.to_numpy(np.int64), size, key))

    @F.pandas_udf("binary")
    def record_of(bodies: pd.Series) -> pd.Series:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        return pd.Series([unpack(b).ljust(ID_BYTES * seq_len, b"\0") for b in bodies], dtype=object)

    placed = (
        dense_index(saved, "__row", "index")
        .drop("__row")
        .withColumn("slot", slot_of("index"))
        .withColumn("shard", F.floor(F.col("slot") / shard_rows).cast("int"))
    )
    path = scratch.place("shards")
    (
        placed.select("shard", "slot", "body")
        .repartitionByRange(parts_for(spark), "shard")
        .sortWithinPartitions("shard", "slot")
        .select("shard", record_of("body").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END)
        .partitionBy("shard")
        .text(path)
    )
    record = F.col("slot") % shard_rows
    stride = ID_BYTES * seq_len + len(RECORD_END)
    return Order(
        path,
        seq_len,
        shard_rows,
        placed.drop("body").withColumns({"record": record, "byte_offset": record * stride}),
    )


def read_slots(spark: SparkSession, order: Order, first: int, count: int) -> np.ndarray:
    """Ids of ``count`` slots of one shard from slot ``first`` on, one row a slot.

    One seek and one read; ask for no more than fits in the caller's memory.
    """
    shard, record = divmod(first, order.shard_rows)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{order.path}/shard={shard}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(names) != 1:
        raise ValueError(f"shard {shard} has {len(names)} files")
    stream = fs.open(names[0])
    try:
        stream.seek(record * order.stride)
        raw = bytes(stream.readNBytes(count * order.stride))
    finally:
        stream.close()
    return np.frombuffer(raw, "<u2").reshape(-1, order.seq_len + 1)[:, :-1]
