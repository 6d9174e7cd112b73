"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Two tokenizations of one text are two sorted lists of token ends. Merging the
lists visits every place where a token ends; between two neighbouring places
one token of A and one of B overlap (a link), and a place where tokens of both
end closes a group. The merge is cut by merge-path partitioning: a binary
search on each of the evenly spaced diagonals of the merge grid finds how many
ends of A and of B come before it, so all pieces between diagonals are the same
number of steps, whatever texts and tokens they hold, and need nothing of each
other. Pieces emit their links and the common ends they meet; put one after
the other, common ends cut the tokens into groups, also those that begin in
one piece and end in a later one.

Work is done by blocks of documents of bounded size. A block is encoded and
merged slice by slice, of which only links as numbers and written groups stay in
memory. It lists its distinct linked id pairs once; those lists, not links, are
counted over the corpus and given back to their blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import Scratch, check_columns, col
from tessera.llm.tokens import byte_letters, text_slices

# Steps of the merge in one piece.
PIECE = 256
# Text that one block holds; a longer text is a block by itself.
BLOCK_BYTES = 4 << 20
# Text of a block that is encoded and merged at a time; a longer text is a slice by itself.
SLICE_BYTES = 256 << 10

# Fixed value: how byte-level BPE cuts a text before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Outside of Latin, Greek, Cyrillic and general punctuation, letters may have been
# added to Unicode after one of the libraries.
_NEWER = re.compile("[^\0-ԧ -⁯]").search
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class BytePairs:
    """Tokenizer A: byte-level BPE of a ``tokenizers`` JSON file, special tokens as plain text."""

    def __init__(self, path: str):
        import json
        import os

        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special
        }
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        # The file lists ids in merge order, so ids are ranks.
        self._plain = tiktoken.Encoding(
            "bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self._whole.encode(t, add_special_tokens=False).ids if _NEWER(t) else self._plain(t) for t in texts
        ]


class SentencePieces:
    """Tokenizer B: a ``sentencepiece`` model, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self._model.is_byte(i) else None
            self.pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> tuple[BytePairs, SentencePieces]:
    """One pair for each Python worker."""
    return BytePairs(path_a), SentencePieces(path_b)


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """How many ends of A are among the first ``d`` of the merge (A first where equal)."""
    low, high = np.maximum(0, d - len(ends_b)), np.minimum(d, len(ends_a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        a_first = np.zeros(len(d), bool)
        a_first[open_] = ends_a[mid[open_]] <= ends_b[d[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & a_first, mid + 1, low), np.where(open_ & ~a_first, mid, high)
    return low


def merge(
    ends_a: np.ndarray, ends_b: np.ndarray, piece: int = PIECE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links ``(a, b)`` and groups ``(to_a, to_b)`` of two lists of ends over the same bytes.

    ``a[k], b[k]`` are the places of two tokens that overlap, in the order of
    their bytes. Group ``g`` holds A's tokens from ``to_a[g - 1]`` to before
    ``to_a[g]``, and B's likewise. Pieces take their steps side by side: step
    ``s`` of all pieces is one array operation.
    """
    total = len(ends_a) + len(ends_b)
    if not total:
        none = np.empty(0, np.int64)
        return none, none, none, none
    start = np.arange(0, total, piece)
    i = diagonal(ends_a, ends_b, start)
    j = start - i
    beyond = np.full(piece + 1, np.iinfo(np.int64).max)
    # The end of A before place i stands at i here, for a tie that the piece before began.
    a, b = np.concatenate([[-1], ends_a, beyond]), np.concatenate([ends_b, beyond])
    at_a, at_b = np.empty((piece, len(start)), np.int64), np.empty((piece, len(start)), np.int64)
    tied = np.empty((piece, len(start)), bool)
    for s in range(piece):
        end_b = b[j]
        take = a[i + 1] <= end_b
        at_a[s], at_b[s] = i, j
        tied[s] = ~take & (a[i] == end_b)
        i = i + take
        j = j + ~take
    # Every piece but the last has all of its steps.
    at_a, at_b, tied = (x.T.ravel()[:total] for x in (at_a, at_b, tied))
    return at_a[~tied], at_b[~tied], at_a[tied], at_b[tied] + 1


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


def _bounds(ids: list[list[int]]) -> np.ndarray:
    return np.cumsum([0, *map(len, ids)])


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self._a, self._b = tokenizers_of(path_a, path_b)
        self.size_b = len(self._b.pieces)
        self._length_a = np.array([len(p) for p in self._a.pieces])
        self._length_b = np.array([len(p) for p in self._b.pieces])
        # An id and what follows it: "," in a list, "|" after A's last, ";" after a group.
        self._written = [f"{i}{end}" for i in range(len(self._a.pieces)) for end in ",|"]
        self._first_b = len(self._written)
        self._written += [f"{i}{end}" for i in range(self.size_b) for end in ",;"]

    def block(
        self, texts: list[str | None], slice_bytes: int = SLICE_BYTES
    ) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """``(n_a, n_b, n_groups, n_links, groups, links)`` for each text; the pairs and their counts.

        ``links`` holds four bytes a link, compressed: its place in the block's
        pairs, each of which is ``a * size_b + b``; the most linked come first,
        so places are small. Texts without tokens have zeros.
        """
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        # Pairs fit in four bytes unless the vocabularies are very large.
        kind = np.min_scalar_type(len(self._length_a) * self.size_b)
        rows: list[tuple] = []
        links = [np.empty(0, kind)]
        for at, to in text_slices(pa.array(texts, pa.large_string()), slice_bytes):
            some, linked = self._slice(texts[at:to])
            rows += some
            links.append(linked.astype(kind))
        pairs, place, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        by_count = np.argsort(-counts, kind="stable")
        rank = np.empty(len(pairs), "<u4")
        rank[by_count] = np.arange(len(pairs))
        place = rank[place]
        done = 0
        for i, row in enumerate(rows):
            rows[i] = (*row, pack(place[done : done + row[3]].tobytes()))
            done += row[3]
        return rows, pairs[by_count].astype(np.int64), counts[by_count]

    def _slice(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray]:
        """``(n_a, n_b, n_groups, n_links, groups)`` for each text; the pair of every link, in order."""
        own = [i for i, t in enumerate(texts) if t]
        raw = [" " + texts[i] for i in own]
        ids_a, ids_b = self._a.encode(raw), self._b.encode([texts[i] for i in own])
        piece_a, piece_b = self._a.pieces.__getitem__, self._b.pieces.__getitem__
        whole = [
            b"".join(map(piece_a, a)) == (r := t.encode()) and b"".join(map(piece_b, b)) == r
            for t, a, b in zip(raw, ids_a, ids_b)
        ]
        own, ids_a, ids_b = ([x for x, ok in zip(y, whole) if ok] for y in (own, ids_a, ids_b))
        flat_a, flat_b, from_a, from_b = _flat(ids_a), _flat(ids_b), _bounds(ids_a), _bounds(ids_b)
        # All texts of the slice lie end to end, so a text's end is a common end.
        link_a, link_b, to_a, to_b = merge(np.cumsum(self._length_a[flat_a]), np.cumsum(self._length_b[flat_b]))
        from_group = np.searchsorted(to_a, from_a, "right")
        from_link = np.searchsorted(link_a, from_a, "left")

        # A's tokens of a group, then B's.
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        place_a, place_b = np.arange(len(flat_a)), np.arange(len(flat_b))
        group_a, group_b = np.searchsorted(to_a, place_a, "right"), np.searchsorted(to_b, place_b, "right")
        before_b = np.concatenate([[0], to_b])
        order[place_a + before_b[group_a]] = 2 * flat_a + (place_a + 1 == to_a[group_a])
        order[place_b + to_a[group_b]] = self._first_b + 2 * flat_b + (place_b + 1 == to_b[group_b])
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        written = self._written.__getitem__
        for k, i in enumerate(own):
            a0, a1, b0, b1 = from_a[k], from_a[k + 1], from_b[k], from_b[k + 1]
            rows[i] = (
                int(a1 - a0),
                int(b1 - b0),
                int(from_group[k + 1] - from_group[k]),
                int(from_link[k + 1] - from_link[k]),
                "".join(map(written, order[a0 + b0 : a1 + b1].tolist()))[:-1],
            )
        return rows, flat_a[link_a] * self.size_b + flat_b[link_b]


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's alignment, as a table of the run.

    ``doc_id, n_a, n_b, n_groups, n_links, groups`` (``a1,a2|b1;a3|b2,b3``),
    ``block, place`` (the block and the document's place there), ``links``
    (places in the block's pairs, compressed) and, with each block's first
    document, ``pairs`` and their ``counts``. A null or empty text, and one that
    a tokenizer does not give back byte by byte, has zeros and empty groups.
    Null and repeated ids stay, a row each; other columns are not read.
    """
    check_columns(docs, [id_col, text_col])
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups", T.StringType()),
            T.StructField("links", T.BinaryType()),
            T.StructField("block", T.LongType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        aligner = Aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, to in text_slices(batch.column(1), BLOCK_BYTES):
                ids = batch.column(0).slice(at, to - at)
                rows, pairs, counts = aligner.block(batch.column(1).slice(at, to - at).to_pylist())
                n = len(rows)
                listed = [[pairs.tolist()], [counts.tolist()]]
                columns = [ids, *map(list, zip(*rows)), [block] * n, list(range(n)), *[x + [None] * (n - 1) for x in listed]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(columns, arrow)],
                    schema=arrow,
                )
                block += 1

    read = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    return scratch.save(read.mapInArrow(blocks, schema), "aligned")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, b, count, best``: links of every id pair over all documents.

    ``best`` says that no other id of A is linked more often with that ``b``.
    Blocks have added up their links; a pair comes once a block.
    """
    listed = aligned.filter(F.col("pairs").isNotNull()).select(
        F.explode(F.arrays_zip("pairs", "counts")).alias("x")
    )
    counted = listed.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("count"))
    counted = counted.withColumns(
        {"a": F.floor(F.col("pair") / size_b).cast("int"), "b": (F.col("pair") % size_b).cast("int")}
    )
    most = counted.groupBy("b").agg(F.max("count").alias("most"))
    return counted.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def document_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``block, place, n_best, count_sum``: each document's links by their corpus counts.

    The counts of a block's pairs come back to it, in the order of its list; a
    block and its list are bounded by its text.
    """
    listed = aligned.filter(F.col("pairs").isNotNull()).select(
        F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair")
    )
    known = listed.join(counts.select("pair", "count", "best"), "pair").select("of", "at", "count", "best")
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("n_best", T.LongType()),
            T.StructField("count_sum", T.LongType()),
        ]
    )

    def total(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        at = pairs["at"].to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at] = pairs["count"].to_numpy()
        best[at] = pairs["best"].to_numpy()
        links = [np.frombuffer(unpack(x), "<u4") for x in docs["links"].to_pylist()]
        return pa.table(
            [
                docs["block"],
                docs["place"],
                pa.array([int(best[x].sum()) for x in links], pa.int64()),
                pa.array([int(count[x].sum()) for x in links], pa.int64()),
            ],
            schema=to_arrow_schema(schema),
        )

    docs = aligned.select("block", "place", "links")
    return docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(total, schema)
