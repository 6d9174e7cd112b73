"""Token ids of whole texts, as little-endian unsigned 32-bit ids.

The vocabulary is a public ``tokenizers`` JSON file (byte-level BPE with word
ends, lower case). White space separates words and no merge crosses it, so a
text's ids are those of its words in order. Words are frequent, so texts are
encoded by the slice: Arrow splits them and lists the distinct words, each of
which is encoded once, and NumPy gathers the ids of all words. Distinct words
of plain Latin letters are cut into pieces by the file's own pattern and
encoded in one call of ``tiktoken`` over the same vocabulary: a word end becomes a
control character that such words must not have, and the ids, which the file
lists in merge order, are the ranks. Every other word goes through
``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of Unicode (Python's str.split() also takes 0x1C to 0x1F).
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD = "[\x1c-\x1f]"
_WORD_END = "\x01"
_BETWEEN = "\n"
# Text that is encoded at a time; a longer text is a slice by itself. A slice's
# arrays take some ten times its bytes, in each worker beside the JVM.
SLICE_BYTES = 2 << 20


def byte_letters() -> dict[str, int]:
    """Byte-level BPE's printable letter for every byte: itself, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def text_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of at most ``limit`` bytes; a longer text is a run by itself."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


class WordEncoder:
    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        self._specials = [t["content"] for t in spec["added_tokens"]]
        end = spec["model"]["end_of_word_suffix"]
        letters = byte_letters()
        ranks: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if i not in special:
                body, tail = (token[: -len(end)], _WORD_END.encode()) if token.endswith(end) else (token, b"")
                ranks[bytes(letters[c] for c in body) + tail] = i
        self._bpe = tiktoken.Encoding(
            "words", pat_str=f"[^{_WORD_END}]+{_WORD_END}", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_ordinary
        split = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        # No piece of the file's pattern holds white space, so a line break stands alone.
        self._pieces = regex.compile(f"(?:{split})|{_BETWEEN}").findall
        self._between = ranks[_BETWEEN.encode() + _WORD_END.encode()]
        # Fixed value: from U+0300 on, letters may combine or change their order.
        odd = "[\x1c-\x1f" + _WORD_END + "\u0300-\U0010ffff]"
        self._not_plain = re.compile("|".join([odd, *map(re.escape, self._specials)])).search

    def _plain(self, words: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` (each ends with ``_BETWEEN``), and the number of each word's ids."""
        pieces = self._pieces(words.lower())
        ids = np.array(self._bpe(_WORD_END.join([*pieces, ""])), np.uint32)
        between = ids == self._between
        return ids[~between], np.diff(np.flatnonzero(between), prepend=-1) - 1

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and the place and number of each word's ids in it."""
        if not len(words):
            return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        whole = pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string()))
        text = pc.binary_join(whole, _BETWEEN)[0].as_py() + _BETWEEN
        if not self._not_plain(text):
            pool, count = self._plain(text)
            return pool, np.cumsum(count) - count, count
        each = text.split(_BETWEEN)[:-1]
        odd = [i for i, w in enumerate(each) if self._not_plain(w)]
        found = [e.ids for e in self._whole.encode_batch([each[i] for i in odd], add_special_tokens=False)]
        for i in odd:
            each[i] = ""
        pool, count = self._plain(_BETWEEN.join([*each, ""]))
        start = np.cumsum(count) - count
        count[odd] = [len(x) for x in found]
        start[odd] = len(pool) + np.cumsum(count[odd]) - count[odd]
        return np.concatenate([pool, *[np.asarray(x, np.uint32) for x in found]]), start, count

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and where each text's begin; one more entry ends the last."""
        if pc.any(pc.match_substring_regex(texts, _ODD)).as_py():
            split = pa.array([_SPACE.split(t or "") for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        each = pc.dictionary_encode(split.flatten())
        pool, start, count = self._words(each.dictionary)
        word = each.indices.to_numpy(zero_copy_only=False)
        number = count[word]
        ends = np.cumsum(number)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(start[word] - (ends - number), number) + np.arange(total)
        begins = split.offsets.to_numpy() - split.offsets[0].as_py()
        return pool[place], np.concatenate([[0], ends])[begins]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text without special tokens added, four bytes each; a null is empty."""
        for at, to in text_slices(texts, SLICE_BYTES):
            ids, begins = self.encode_slice(texts.slice(at, to - at))
            for a, b in zip(begins[:-1], begins[1:]):
                yield ids[a:b].astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    return WordEncoder(path)


def vocabulary_size(path: str) -> int:
    """One more than the largest id of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
