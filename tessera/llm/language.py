"""Language identification by cross-parsing against suffix automata of labelled text.

A text is parsed from left to right into the longest phrases that occur anywhere
in a language's sample; the suffix automaton of the sample follows one letter at
a time and gives up where the phrase ends. Each phrase costs as much as a place
in the sample takes to write down, so the language whose sample explains the
text in the fewest phrases, normalised by the logarithm of the sample's size
and the length of the text (Ziv and Merhav's cross-entropy estimate), wins.

Samples are small and bounded; texts are parsed whole, in stretches of fixed
length side by side, so one step of all stretches and all languages is one
array operation, however long a text is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import check_columns, col
from tessera.llm.tokens import text_slices

# Bounds of what is learnt: the most frequent languages, documents of each, letters
# of a document (a longer one gives a stretch that starts at a hashed place) and
# bytes of a language's sample.
MOST_LANGUAGES = 200
SAMPLE_DOCUMENTS = 64
SAMPLE_LETTERS = 2_000
SAMPLE_BYTES = 32_768
# Bound of all automata of a worker; with many languages samples get shorter.
TABLE_BYTES = 192 << 20
UNKNOWN = "und"

# A phrase never goes beyond a stretch, for any language.
_STRETCH = 512
_SLICE_BYTES = 4 << 20
_NO_LETTERS = re.compile(r"[\W\d_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learnt from; a null id is not one of them."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> bytes:
    """A text's letters in lower case, whatever stands between them a single space."""
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> dict[str, bytes]:
    """A sample of each language, from the texts and labels that are not held out.

    Documents are drawn by the hash of their text, equal texts once. At most
    ``MOST_LANGUAGES * sample_documents`` stretches of ``SAMPLE_LETTERS`` letters
    reach the driver, whatever the size of the table.
    """
    check_columns(docs, [id_col, text_col, lang_col])
    labelled = docs.filter(~held_out(id_col)).select(
        col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"), F.xxhash64(col(text_col)).alias("h")
    )
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    keys = labelled.select("lang", "h").distinct()
    # The least hashes of each part of a language first: no task orders a whole language.
    by_part = Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h")
    keys = keys.withColumn("k", F.row_number().over(by_part)).filter(F.col("k") <= sample_documents)
    keys = keys.join(frequent.select("lang"), "lang")
    chosen = keys.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = chosen.filter(F.col("k") <= sample_documents).select("lang", "h")
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - SAMPLE_LETTERS, F.lit(0)) + 1).cast("int") + 1
    stretch = F.substring(F.col("text"), start, F.lit(SAMPLE_LETTERS))
    # At most MOST_LANGUAGES * sample_documents hashes: small enough to broadcast, so no text is shuffled.
    rows = labelled.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(stretch).alias("text")).collect()
    samples: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        samples.setdefault(row["lang"], []).append(letters(row["text"]))
    most = len({b for parts in samples.values() for p in parts for b in p}) + 2
    bytes_each = min(SAMPLE_BYTES, TABLE_BYTES // (8 * most * max(1, len(samples))))
    # A zero byte, which no text's letters have, stands between documents.
    return {lang: b"\0".join(parts)[:bytes_each] for lang, parts in samples.items()}


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton that reads exactly the substrings of ``text``; state 0 is first."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for byte in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and byte not in moves[p]:
            moves[p][byte] = state
            p = link[p]
        if p >= 0:
            q = moves[p][byte]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[state] = clone
                while p >= 0 and moves[p].get(byte) == q:
                    moves[p][byte] = clone
                    p = link[p]
        last = state
    return moves


class Parser:
    """The automata of all languages as one table; row 0 is no state, each has its own first."""

    def __init__(self, samples: Mapping[str, bytes]):
        self.languages = sorted(samples)
        alphabet = sorted({b for s in samples.values() for b in s} - {0})
        self._symbol = np.zeros(256, np.uint8)
        self._symbol[alphabet] = np.arange(1, len(alphabet) + 1) % 256
        self._width = len(alphabet) + 1
        tables, first, at = [np.zeros((1, self._width), np.int32)], [], 1
        for lang in self.languages:
            moves = suffix_automaton(samples[lang])
            table = np.zeros((len(moves), self._width), np.int32)
            for state, row in enumerate(moves):
                for byte, to in row.items():
                    if byte:
                        table[state, self._symbol[byte]] = to + at
            tables.append(table)
            first.append(at)
            at += len(moves)
        self._table = np.concatenate(tables).ravel()
        self._first = np.array(first, np.int64)[:, None]
        self._bits = np.log2([max(2, len(samples[lang])) for lang in self.languages])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """How many phrases each language needs for each text."""
        count = np.zeros((len(texts), len(self.languages)), np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        if not size.sum():
            return count
        whole = self._symbol[np.frombuffer(b"".join(texts), np.uint8)]
        begin = np.cumsum(size) - size
        pieces = -(-size // _STRETCH)
        of = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begin[of] + nth * _STRETCH
        length = np.minimum(_STRETCH, size[of] - nth * _STRETCH)
        longest = np.argsort(-length, kind="stable")
        of, start, length = of[longest], start[longest], length[longest]
        open_ = np.searchsorted(-length, -np.arange(1, _STRETCH + 1), "right")
        found = np.zeros((len(self.languages), len(of)), np.int32)
        state = np.repeat(self._first, len(of), axis=1)
        fresh = self._first * self._width
        for step in range(int(length[0])):
            n = open_[step]
            symbol = whole[start[:n] + step]
            now = state[:, :n]
            to = self._table[now * self._width + symbol].astype(np.int64)
            ended = to == 0
            found[:, :n] += ended | (now == self._first)
            # After a phrase the next one starts with this letter; one that the sample
            # lacks is a phrase by itself.
            to = np.where(ended, self._table[fresh + symbol], to)
            state[:, :n] = np.where(to == 0, self._first, to)
        for k in range(len(self.languages)):
            count[:, k] = np.bincount(of, found[k], len(texts)).astype(np.int64)
        return count

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """The language of each text, and by what share of its phrases the second is worse."""
        cost = self.phrases(texts) * self._bits
        order = np.argsort(cost, axis=1, kind="stable")
        best = np.take_along_axis(cost, order[:, :1], 1)[:, 0]
        if len(self.languages) > 1:
            second = np.take_along_axis(cost, order[:, 1:2], 1)[:, 0]
            score = np.where(second > 0, 1 - best / np.where(second > 0, second, 1), 0.0)
        else:
            score = np.ones(len(texts))
        return [self.languages[k] for k in order[:, 0]], score.tolist()


@lru_cache(maxsize=1)
def _parser(samples: tuple[tuple[str, bytes], ...]) -> Parser:
    """One for each Python worker and model."""
    return Parser(dict(samples))


def identify(
    docs: DataFrame, samples: Mapping[str, bytes], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every whole text.

    A null text and one without a letter are ``und`` with score 0, as is every
    text where no language was learnt; of equally good languages the first by
    name is taken. Null and repeated ids stay, a row each; other columns are
    not read, the languages of ``docs`` neither.
    """
    check_columns(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    model = tuple(sorted(samples.items()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        parser = _parser(model)
        for batch in batches:
            for at, to in text_slices(batch.column(2), _SLICE_BYTES):
                part = batch.slice(at, to - at)
                langs, scores = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                known = [i for i, ok in enumerate(part.column(3).to_pylist()) if ok and model]
                if known:
                    texts = part.column(2).take(pa.array(known)).to_pylist()
                    for i, lang, value in zip(known, *parser.predict([letters(t) for t in texts])):
                        langs[i], scores[i] = lang, value
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(arrow[0].type), part.column(1), pa.array(langs), pa.array(scores)], schema=arrow
                )

    read = docs.select(
        col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        col(text_col).alias("text"),
        col(text_col).rlike(r"\p{L}").alias("letters"),
    )
    return read.mapInArrow(score, schema)
