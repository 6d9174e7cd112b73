"""Phrase collocations: frequent word n-grams and how much more often they come than by chance.

Documents of a language are laid end to end into shards of bounded size, as
ids of the shard's own words with id 0 between pieces. A shard is indexed both
ways (the bidirectional BWT): one half sorts places by the words that follow
and keeps the word before each, the other half sorts them by the words before
and keeps the word after. An n-gram is one interval in each half. Extending all
intervals by a word to the left, and all by a word to the right, gives the
n-grams one word longer with their counts; those found both ways have a
prefix and a suffix that the corpus knows as frequent. Their counts are summed
over shards, what reaches the least frequency goes back to the shards that
hold it, and the next depth extends that. Contexts are sorted as deep as the
longest phrase needs, no deeper.

Most n-grams of frequent parts are rare themselves. So before a depth is
extended, shards count its n-grams by a hash of 32 bits (Park, Chen and Yu,
1995): sorted lists of buckets and counts, about two bytes an entry, are summed
over shards, and buckets that reach the least frequency come back. Only their
places stay in the text that is indexed, and only their n-grams become rows.
What little is left of several shards of a language is laid end to end and is
one shard from then on, indexed by stretches, so an n-gram has few rows.

No phrase is lost on the way: a phrase is never more frequent than its prefix
and its suffix, nor than its bucket. A shard lists each n-gram once, so no key
has more rows than there are shards, and a frequent word costs no more rows than
another.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import Scratch, check_columns, col, dense_index, part_of, parts_for, place_in_part, row_position

# Words of the shards that one task holds open; a longer text is a shard by itself.
SHARD_WORDS = 4_000_000
# Shards of a language that one task narrows and lays together hold so many times as many words.
HOME_SHARDS = 3
# Contexts are sorted to four words, so phrases have five at most.
MOST_WORDS = 5

# Fixed value: an odd 64-bit multiplier.
_MIX = np.uint64(0x9E3779B97F4A7C15)
# A-Z become lower case, these characters end a piece, a tab is a space.
_BREAK = b"\xff"  # in no UTF-8 text
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\n\x0b\x0c\r" + b"\t",
    b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" ",
)


class _Numbers(dict):
    """Numbers for words in the order they come; the break is 0."""

    def __init__(self):
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def words_of(text: str) -> list[bytes]:
    """The words of a text, with ``_BREAK`` where a piece ends."""
    return text.encode().translate(_FOLD).replace(_BREAK, b" " + _BREAK + b" ").split()


class _Half:
    """One direction of the index: +1 sorts by what follows, -1 by what comes before."""

    def __init__(self, text: np.ndarray, way: int):
        n = len(text)
        symbols = int(text.max()) + 1
        two = np.unique(text * np.int64(symbols) + np.roll(text, -way), return_inverse=True)[1]
        four = two * np.int64(two.max() + 1) + np.roll(two, -2 * way)
        self.place = np.argsort(four, kind="stable")
        self.beside = text[(self.place - way) % n].astype(np.int64)
        by = np.argsort(self.beside, kind="stable")
        self.step = np.empty(n, np.int64)
        self.step[by] = np.arange(n)
        self._sorted = self.beside[by] * n + by
        self._n, self._symbols = n, symbols

    def search(self, patterns: Iterator[np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals (start, length) of ``count`` patterns, from arrays of their words, nearest last."""
        low, high = np.zeros(count, np.int64), np.full(count, self._n)
        for word in patterns:
            low = np.searchsorted(self._sorted, word * self._n + low)
            high = np.searchsorted(self._sorted, word * self._n + high)
        return low, high - low

    def rows(self, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every row of the intervals: its interval, itself; and where each interval starts among them."""
        start = np.cumsum(length) - length
        of = np.repeat(np.arange(len(low)), length)
        return of, np.arange(len(of)) - start[of] + low[of], start

    def extend(self, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """All intervals one word longer: ``of, start, smaller, length, row``.

        ``of`` is the interval it comes from, ``smaller`` how many of that
        interval's rows have a lesser word, and ``row`` one row of its own there.
        """
        of, row, start = self.rows(low, length)
        word = self.beside[row]
        key, first, count = np.unique(of * np.int64(self._symbols) + word, return_index=True, return_counts=True)
        of = of[first]
        smaller = np.cumsum(count) - count - start[of]
        real = key % self._symbols > 0
        return of[real], self.step[row[first]][real], smaller[real], count[real], row[first][real]


def longer_grams(
    text: np.ndarray, at: np.ndarray | None, width: int, words: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams one word longer than the known ones, both of whose parts are known.

    ``at`` holds a place in ``text`` of every known n-gram of ``width`` words;
    or ``words`` has their words, a row each, and they may be missing there.
    Returns ``prefix, suffix`` (which of the known ones), ``count`` and ``at``
    for each, and the places of ``text`` that known n-grams cover.
    """
    if words is None:
        words = text[at[:, None] + np.arange(width)]
    words = words.astype(np.int64)
    ahead, back = _Half(text, 1), _Half(text, -1)
    low, count = ahead.search((words[:, k] for k in reversed(range(width))), len(words))
    low_back, _ = back.search((words[:, k] for k in range(width)), len(words))

    of_suffix, left, _, counted, row = ahead.extend(low, count)
    of_prefix, _, smaller, _, _ = back.extend(low_back, count)
    right = low[of_prefix] + smaller
    # A longer n-gram's interval starts at the same row, from whichever side it was found.
    _, k_left, k_right = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    start = ahead.place[ahead.rows(low, count)[1]]
    covered = np.zeros(len(text) + 1, np.int64)
    covered[start] += 1
    covered[start + width] -= 1
    return (
        of_prefix[k_right],
        of_suffix[k_left],
        counted[k_left],
        ahead.place[row[k_left]] - 1,
        np.cumsum(covered[:-1]) > 0,
    )


def restricted(text: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``text`` with each run of places not kept shortened to one 0; and where each place went.

    A 0 stands first and last, and symbols are numbered anew.
    """
    stays = keep.copy()
    stays[1:] |= keep[:-1]
    out = np.concatenate([[0], np.where(keep, text, 0)[stays], [0]]).astype(np.int64)
    used = np.zeros(int(out.max()) + 1, np.int64)
    used[out] = 1
    used[0] = 1
    return (np.cumsum(used) - 1)[out].astype("<i4"), np.cumsum(stays)


def buckets(text: np.ndarray, marks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from which ``width`` words of one piece follow, and a 32-bit hash of those words' ``marks``."""
    places = max(0, len(text) - width + 1)
    hashed, whole = np.zeros(places, np.uint64), np.ones(places, bool)
    for k in range(width):
        word = text[k : k + places]
        hashed = (hashed ^ (hashed >> np.uint64(29)) ^ marks[word]) * _MIX
        whole &= word > 0
    at = np.flatnonzero(whole)
    return at, (hashed[at] >> np.uint64(32)).astype("<u4")


def _packed(sorted_: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as gaps, and others beside them, byte planes compressed."""
    import zstandard

    numbers = np.concatenate([np.diff(sorted_, prepend=sorted_.dtype.type(0)), *more]).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(packed: bytes, columns: int) -> np.ndarray:
    """What ``_packed`` was given, a row each."""
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view("<u4").reshape(columns, -1).copy()
    numbers[0] = np.cumsum(numbers[0], dtype=np.uint32)
    return numbers


def bucket_lists(text: np.ndarray, marks: np.ndarray, width: int, parts: int) -> list[bytes | None]:
    """Buckets of all n-grams of ``width`` words with their counts, packed, in ``parts`` equal ranges of buckets."""
    found, count = np.unique(buckets(text, marks, width)[1], return_counts=True)
    cut = np.searchsorted(found, np.arange(parts + 1, dtype=np.int64) * 2**32 // parts)
    return [_packed(found[a:b], count[a:b]) if b > a else None for a, b in zip(cut[:-1], cut[1:])]


def _passing(lists: DataFrame, least: int) -> DataFrame:
    """``home, shard, passing``: each shard's buckets that all shards together reach ``least`` times, a row a part."""
    schema = T.StructType(
        [T.StructField("home", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("passing", T.BinaryType())]
    )

    def total(rows: pa.Table) -> pa.Table:
        each = [_unpacked(x, 2) for x in rows["list"].to_pylist()]
        bucket, count = np.concatenate(each, axis=1)
        place = np.unique(bucket, return_inverse=True)[1]
        passes = (np.bincount(place, count) >= least)[place]
        ends = np.cumsum([x.shape[1] for x in each])
        left = [bucket[b - x.shape[1] : b][passes[b - x.shape[1] : b]] for b, x in zip(ends, each)]
        packed = [_packed(x) if len(x) else None for x in left]
        answer = pa.table([rows["home"], rows["shard"], pa.array(packed, pa.binary())], schema=to_arrow_schema(schema))
        return answer.filter(pc.is_valid(answer["passing"]))

    return lists.groupBy("part").applyInArrow(total, schema)


def shards(
    docs: DataFrame, scratch: Scratch, lang_col: str, text_col: str, shard_words: int, parts: int
) -> DataFrame:
    """``shard, lang, n, ids, words``: texts by language, and each word with its count and a place.

    ``lists`` has the buckets of pairs of words, ``spread`` numbers to deal
    shards by. Shards are made where the documents are read; no text is shuffled.
    """
    schema = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("places", T.ArrayType(T.LongType())),
            T.StructField("lists", T.ArrayType(T.BinaryType())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        numbers: dict[str, _Numbers] = {}
        ids: dict[str, array] = {}
        held = 0

        def shard(lang: str) -> pa.RecordBatch:
            text = np.frombuffer(ids.pop(lang), np.int32)
            words = list(numbers.pop(lang))[1:]
            own = zlib.crc32(lang.encode() + b"\0")
            marks = np.array([0, *(zlib.crc32(w, own) for w in words)], np.uint64)
            words = [w.decode() for w in words]
            counts = np.bincount(text, minlength=len(words) + 1)[1:]
            places = np.empty(len(words) + 1, np.int64)
            places[text[::-1]] = np.arange(len(text))[::-1]
            values = [lang, int(counts.sum()), text.astype("<i4").tobytes(), words, counts.tolist(), places[1:].tolist()]
            values.append(bucket_lists(text, marks, 2, parts))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                if lang not in ids:
                    numbers[lang], ids[lang] = _Numbers(), array("i", [0])
                own = ids[lang]
                held -= len(own)
                own.extend(map(numbers[lang].__getitem__, words_of(text)))
                own.append(0)
                held += len(own)
                if held >= shard_words:
                    largest = max(ids, key=lambda x: len(ids[x]))
                    held -= len(ids[largest])
                    yield shard(largest)
        for lang in list(ids):
            yield shard(lang)

    read = docs.select(
        F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    )
    saved = scratch.save(read.mapInArrow(cut, schema).withColumn("row", row_position()), "shards")
    row = F.col("row")
    return dense_index(saved, "row", "shard").withColumn("spread", part_of(row) + place_in_part(row)).drop("row")


def _mark(lang: Column, word: Column) -> Column:
    """The mark that :func:`shards` gives a word."""
    return F.crc32(F.concat(lang, F.lit("\0"), word))


_STEP = T.StructType([T.StructField(n, T.BinaryType()) for n in ("ids", "marks", "list")] + [
    T.StructField(n, T.LongType()) for n in ("part", "shard", "prefix", "suffix", "count", "at")
])


def stretches(text: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about ``most`` places that begin and end with a 0, which two share."""
    zeros = np.flatnonzero(text == 0)
    at, last = 0, len(text) - 1
    while at < last:
        to = int(zeros[min(np.searchsorted(zeros, at + most), len(zeros) - 1)])
        yield at, to + 1
        at = to


class _Narrowed:
    """What is left of a shard's text: places of n-grams of ``width + 1`` words whose bucket passes.

    ``words`` and ``gram`` are the known n-grams that are still there, ``passes``
    tells where those that pass begin.
    """

    def __init__(self, text: np.ndarray, marks: np.ndarray, words: np.ndarray, gram: np.ndarray, passing: np.ndarray):
        width = words.shape[1]
        start, bucket = buckets(text, marks, width + 1)
        start = start[np.isin(bucket, passing)]
        cover = np.zeros(len(text) + 1, np.int64)
        cover[start] += 1
        cover[start + width + 1] -= 1
        keep = np.cumsum(cover[:-1]) > 0
        self.text, moved = restricted(text, keep)
        # Symbols are numbered anew; known n-grams that hold one which is gone are gone too.
        symbol = np.zeros(len(marks), np.int64)
        symbol[text[keep]] = self.text[moved[keep]]
        self.marks = np.zeros(int(self.text.max()) + 1, np.uint64)
        self.marks[symbol[text[keep]]] = marks[text[keep]]
        words = symbol[words]
        there = (words > 0).all(axis=1)
        self.words, self.gram = words[there], gram[there]
        self.passes = np.zeros(len(self.text), bool)
        self.passes[moved[start]] = True

    def lay(self, others: list[_Narrowed]) -> None:
        """Lay others behind this one; all know their words by the same numbers."""
        every = [self, *others]
        grams, place = np.unique(np.concatenate([x.gram for x in every]), return_inverse=True)
        marks, done, texts = np.zeros(len(grams) + 1, np.uint64), 0, []
        for x in every:
            symbol = np.zeros(len(x.marks), np.int64)
            symbol[x.words[:, 0]] = 1 + place[done : done + len(x.gram)]
            done += len(x.gram)
            marks[symbol[1:]] = x.marks[1:]
            texts.append(symbol[x.text])
        self.text, self.marks = np.concatenate(texts).astype("<i4"), marks
        self.words, self.gram = np.arange(1, len(grams) + 1)[:, None], grams
        self.passes = np.concatenate([x.passes for x in every])


def _deeper(
    texts: DataFrame, known: DataFrame, passing: DataFrame, width: int, last: bool, parts: int, shard_words: int
) -> DataFrame:
    """The shards' n-grams of ``width + 1`` words whose buckets pass.

    Unless ``last``, also what is left of their texts, with the marks of its
    words, and the buckets of its n-grams of ``width + 2`` words. Shards with one
    ``home`` become one, named after the first and indexed by stretches of
    ``shard_words``.
    """

    def step(texts: pa.Table, known: pa.Table) -> pa.Table:
        arrow = to_arrow_schema(_STEP)
        out = [arrow.empty_table()]
        known = known.sort_by("shard")
        shard_of = known["shard"].to_numpy()

        def rows(n: int, **columns) -> pa.Table:
            return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def narrowed(shard: int, row: int) -> _Narrowed | None:
            first, end = np.searchsorted(shard_of, [shard, shard + 1])
            own = known.slice(first, end - first)
            listed = [_unpacked(x, 1)[0] for x in own["passing"].drop_null().to_pylist()]
            own = own.filter(pc.is_valid(own["gram"]))
            if not own.num_rows or not listed:
                return None
            text = np.frombuffer(texts["ids"][row].as_py(), "<i4")
            at, gram = own["at"].to_numpy(), own["gram"].to_numpy()
            if width == 1:
                frequent, marks = np.zeros(int(text.max()) + 1, bool), np.zeros(int(text.max()) + 1, np.uint64)
                frequent[text[at]] = True
                marks[text[at]] = own["mark"].to_numpy()
                text = np.where(frequent[text], text, 0)
            else:
                marks = np.frombuffer(texts["marks"][row].as_py(), "<u4").astype(np.uint64)
            left = _Narrowed(text, marks, text[at[:, None] + np.arange(width)], gram, np.concatenate(listed))
            return left if left.passes.any() else None

        def listed(shard: int, left: _Narrowed) -> None:
            each = []
            for first, end in stretches(left.text, shard_words):
                prefix, suffix, count, found, _ = longer_grams(left.text[first:end], None, width, left.words)
                each.append((prefix * np.int64(len(left.gram)) + suffix, count, found + first))
            pair, count, found = map(np.concatenate, zip(*each))
            # N-grams that only stand where two that pass meet or overlap are not listed.
            pair, count, found = (x[left.passes[found]] for x in (pair, count, found))
            pair, place, same = np.unique(pair, return_index=True, return_inverse=True)
            prefix, suffix = np.divmod(pair, len(left.gram))
            count, found = np.bincount(same, count, len(pair)).astype(np.int64), found[place]
            n = len(count)
            named = dict(prefix=left.gram[prefix], suffix=left.gram[suffix], count=count, at=found)
            out.append(rows(n, shard=np.full(n, shard), **named))
            if not last:
                marks = left.marks.astype("<u4").tobytes()
                out.append(rows(1, shard=[shard], ids=[left.text.tobytes()], marks=[marks]))
                lists = bucket_lists(left.text, left.marks, width + 2, parts)
                held = [k for k, x in enumerate(lists) if x is not None]
                out.append(rows(len(held), shard=[shard] * len(held), part=held, list=[lists[k] for k in held]))

        held = sorted((shard, row) for row, shard in enumerate(texts["shard"].to_pylist()))
        held = [(shard, left) for shard, row in held if (left := narrowed(shard, row)) is not None]
        if held:
            (shard, first), *others = held
            if others:
                first.lay([x for _, x in others])
            listed(shard, first)
        return pa.concat_tables(out)

    known = known.select(F.col("home").alias("of"), "shard", "at", "gram", "mark")
    known = known.unionByName(passing.withColumnRenamed("home", "of"), allowMissingColumns=True)
    return texts.groupBy("home").cogroup(known.groupBy("of")).applyInArrow(step, _STEP)


def _frequent(rows: DataFrame, key: list[str], least: int, scratch: Scratch) -> DataFrame:
    """Rows of n-grams found ``least`` times over all shards, with ``f`` and ``gram``, a number for each."""
    same = Window.partitionBy(*key)
    place = F.shiftleft(F.col("shard"), 32) + F.col("at")
    summed = rows.withColumns({"f": F.sum("count").over(same), "gram": F.min(place).over(same)})
    return scratch.save(summed.filter(F.col("f") >= least).withColumn("own", place), "frequent")


def _once(frequent: DataFrame) -> DataFrame:
    return frequent.filter(F.col("gram") == F.col("own"))


def collocations(
    docs: DataFrame,
    scratch: Scratch,
    least: int,
    top: int,
    max_words: int = MOST_WORDS,
    lang_col: str = "lang",
    text_col: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase has 2 to ``max_words`` words of one piece and comes ``a >= least``
    times among the language's ``n`` words. Of its cuts into two, the one with
    the least score ``1000 a n / (l r)``, rounded down, counts (the earliest of
    equals); ``l`` and ``r`` are the frequencies of its parts. Phrases inside a
    longer one that comes as often are left out. Ranks go by score, then ``a``
    (both falling), then the phrase in byte order. A null language is ``und``, a
    null text empty; repeated rows count each; other columns are not read; an
    empty table, or one with nothing frequent, gives no rows.
    """
    check_columns(docs, [lang_col, text_col])
    if not 2 <= max_words <= MOST_WORDS:
        raise ValueError(f"max_words must be 2 to {MOST_WORDS}")
    parts = parts_for(docs.sparkSession)
    texts = shards(docs, scratch, lang_col, text_col, shard_words, parts)
    totals = texts.groupBy("lang").agg(F.sum("n").alias("n"))
    homes = totals.select("lang", F.floor(F.col("n") / (HOME_SHARDS * shard_words) + 1).alias("homes"))
    texts = texts.join(F.broadcast(homes), "lang").withColumn("home", F.xxhash64("lang", F.pmod("spread", "homes")))
    listed = texts.select("shard", "home", "lang", F.explode(F.arrays_zip("words", "counts", "places")).alias("x"))
    listed = listed.select(
        "shard", "home", "lang", F.col("x.words").alias("word"), F.col("x.counts").alias("count"), F.col("x.places").alias("at")
    )
    known = _frequent(listed, ["lang", "word"], least, scratch).withColumn("mark", _mark(F.col("lang"), F.col("word")))
    grams = _once(known).select(
        "gram", "lang", F.array("word").alias("words"), F.array("f").alias("heads"), F.array("f").alias("tails")
    )
    levels, inner = [], []
    lists = texts.select("shard", "home", F.posexplode("lists").alias("part", "list")).filter(F.col("list").isNotNull())
    texts = texts.select("shard", "home", "ids", F.lit(None).cast("binary").alias("marks"))
    for width in range(1, max_words):
        passing = _passing(lists, least)
        last = width + 1 == max_words
        found = scratch.save(_deeper(texts, known, passing, width, last, parts, shard_words), "grams")
        found = found.withColumn("home", F.col("shard"))
        texts = found.filter(F.col("ids").isNotNull()).select("shard", "home", "ids", "marks")
        lists = found.filter(F.col("list").isNotNull()).select("shard", "home", "part", "list")
        rows = found.filter(F.col("prefix").isNotNull()).drop("ids", "marks", "list", "part")
        known = _frequent(rows, ["prefix", "suffix"], least, scratch)
        known = known.withColumn("mark", F.lit(None).cast("long"))
        longer = _once(known).select(F.col("gram").alias("id"), "prefix", "suffix", "f")
        # ``heads`` and ``tails``: frequencies of the phrase's first and last 1, 2, ... words.
        tail = grams.select(F.col("gram").alias("suffix"), F.col("words").alias("w"), "tails")
        longer = longer.join(grams.drop("tails").withColumnRenamed("gram", "prefix"), "prefix").join(tail, "suffix")
        longer = scratch.save(
            longer.select(
                F.col("id").alias("gram"),
                "prefix",
                "suffix",
                "lang",
                F.concat("words", F.slice("w", -1, 1)).alias("words"),
                F.concat("heads", F.array("f")).alias("heads"),
                F.concat("tails", F.array("f")).alias("tails"),
            ),
            "phrases",
        )
        if longer.isEmpty():
            break
        levels.append(longer.drop("prefix", "suffix"))
        grams = levels[-1]
        if width > 1:
            same = lambda x: F.element_at(x, -1) == F.element_at(x, -2)
            part = F.array(F.when(same("heads"), F.col("prefix")), F.when(same("tails"), F.col("suffix")))
            inside = longer.select(F.explode(part).alias("gram")).filter(F.col("gram").isNotNull()).distinct()
            levels[-2] = levels[-2].join(inside, "gram", "left_anti")
    return _ranked(levels, totals, docs, top)


def _ranked(levels: list[DataFrame], totals: DataFrame, docs: DataFrame, top: int) -> DataFrame:
    columns = ("phrase string", "a bigint", "l bigint", "r bigint", "n bigint", "score bigint")
    if not levels:
        return docs.sparkSession.createDataFrame([], ", ".join(("lang string", "rank bigint", *columns)))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    # Whole numbers of up to 38 digits: `div` rounds down and nothing overflows.
    cuts = F.expr(
        "transform(sequence(1, size(words) - 1), k -> named_struct("
        " 'score', (cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(17,0)))"
        "  div (cast(heads[k - 1] as decimal(18,0)) * cast(tails[size(words) - k - 1] as decimal(18,0))),"
        " 'k', k, 'l', heads[k - 1], 'r', tails[size(words) - k - 1]))"
    )
    scored = (
        phrases.withColumn("a", F.element_at("heads", -1))
        .join(totals, "lang")
        .withColumn("cut", F.array_min(cuts))
        .select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The best of each part of a language first, so that no task ranks a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("part", part)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = first.filter(F.col("rank") <= top).drop("part", "rank")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", *[c.split()[0] for c in columns])


def collocations_sql(least: int, top: int, max_words: int = MOST_WORDS) -> str:
    """DuckDB SQL for the rows of :func:`collocations` over ``documents``."""
    grams = " UNION ALL ".join(
        f"SELECT lang, words[i:i + {w - 1}] AS g FROM pieces, range(1, len(words) - {w - 2}) AS t(i)"
        for w in range(1, max_words + 1)
    )
    return f"""
WITH folded AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM folded)),
totals AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, g, count(*) AS a FROM ({grams}) GROUP BY lang, g HAVING count(*) >= {least}),
cuts AS (
  SELECT f.lang, f.g, f.a, k, x.a AS l, y.a AS r, n,
    (1000::HUGEINT * f.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM f JOIN range(1, {max_words}) AS t(k) ON k < len(f.g)
  JOIN f x ON x.lang = f.lang AND x.g = f.g[1:k]
  JOIN f y ON y.lang = f.lang AND y.g = f.g[k + 1:]
  JOIN totals ON totals.lang = f.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT long.lang, long.g[i:i + w - 1] AS g, long.a
  FROM f long, range(2, {max_words}) AS u(w), range(1, {max_words}) AS t(i)
  WHERE w < len(long.g) AND i + w - 1 <= len(long.g)),
kept AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM best
  WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = best.lang AND p.g = best.g AND p.a >= best.a)),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
  FROM kept)
SELECT * FROM ranked WHERE rank <= {top}
"""
