"""Byte-pair encoding from a tokenizer file, and its inverse.

A word's symbols form a doubly linked list.  A heap holds the mergeable neighbours by (rank,
position); an entry whose symbols have changed since is skipped.  Each merge links out the right
symbol and offers the two new neighbours, so a word of n bytes takes O(n log n), however long.
"""

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import give_back_memory

#: Unicode white space; what str.split() cuts at besides, 0x1C to 0x1F, is not in it.
_SPACES = "\t-\r \x85\xa0  -     　"
_CUT = re.compile(f"[{_SPACES}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Most entries of each half of a store of known chunks or words.
KEPT = 100_000
#: Longest chunk or word, in characters, that is kept.
KEPT_LENGTH = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where it is a printable Latin-1
    character that is not a space, else the next letter from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class _Store:
    """Bounded store of packed ids: a young half takes new and used entries; when it is full it
    becomes the old half, and what was not used since the last change is let go."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def get(self, key: str) -> bytes:
        """What the young half lacks: from the old half, or made."""
        value = self.old.get(key) or self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self.young) >= KEPT:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value


class Codec:
    """Reads a tokenizer file of the supported kind: NFC, white space to one space, lower case;
    words by pattern; byte letters; merges with a mark on a word's last symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError("not a tokenizer file of the supported kind")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError("not a tokenizer file of the supported kind")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        letters = byte_letters()
        self.inner = [self.vocab.get(letters[b], -1) for b in range(256)]
        self.last = [self.vocab.get(letters[b] + self.end, -1) for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            tokens[i] = token
        self.tokens = np.array(tokens, dtype=object)
        self.kept, self.kept_words = _Store(self._chunk), _Store(self._word)

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        n = len(word)
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, found[1], ids[i], ids[i + 1]))
        heapify(heap)
        while heap:
            _, i, new, left, right = heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: a symbol was merged since
            ids[i], ids[j] = new, -2
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heappush(heap, (found[0], i, found[1], new, ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], new))):
                heappush(heap, (found[0], h, found[1], ids[h], new))
        out, i = [], 0
        while i >= 0:
            if ids[i] >= 0:
                out.append(ids[i])
            i = after[i]
        return out

    def forget(self) -> None:
        """Let the known chunks and words go."""
        self.kept, self.kept_words = _Store(self._chunk), _Store(self._word)

    def _chunk(self, chunk: str) -> bytes:
        """Packed ids of a run of text without white space."""
        # letter by letter, so a final sigma is like any other
        plain = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        known, words = self.kept_words.young, self.kept_words.get
        return b"".join([known.get(w) or words(w) for w in self.words.findall(plain)])

    def _word(self, word: str) -> bytes:
        return np.array(self.merge_word(word.encode("utf-8")), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        chunks = _CUT.split(text) if _SEPARATORS.search(text) else text.split()
        known, others = self.kept.young, self.kept.get
        return b"".join([known.get(c) or others(c) for c in chunks if c])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.at_special is None or "<|" not in text and not self.at_special.search(text):
            return self._plain(text)
        out, start = [], 0
        for found in self.at_special.finditer(text):
            out += [self._plain(text[start : found.start()]), np.array([self.special[found[0]]], "<u4").tobytes()]
            start = found.end()
        return b"".join([*out, self._plain(text[start:])])

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's strings, joined by a space as the file names no decoder."""
        return " ".join(self.tokens[ids].tolist())


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


#: What ``coded`` can give for a text, and as what type.
FIELDS = {"ids": ("array<int>", pa.list_(pa.int32())), "packed": ("binary", pa.binary()), "decoded": ("string", pa.string())}


#: Texts whose ids and decoded texts are held at once.
TEXTS_AT_ONCE = 200


def coded(df: DataFrame, path: str, *fields: str, text: str = "text", into: str = "code") -> DataFrame:
    """``df`` with a struct ``into`` of ``fields`` in place of the column ``text``, each text encoded
    once, over whole texts; null counts as empty.

    ``ids`` are the token ids, ``packed`` the same as little-endian unsigned 32-bit integers,
    ``decoded`` the text they stand for.  The tokenizer file is read on each worker from ``path``,
    which every node must have.  Results leave in small batches, so memory is bounded by the longest texts.  Rows
    that repeat stay, an empty table stays empty, and other columns pass, whatever their names,
    but one called ``into``, which is replaced.
    """
    others = [c for c in df.columns if c not in (text, into)]
    kind = T.StructType([*(df.schema[c] for c in others), *T._parse_datatype_string(f"`{into}` struct<{', '.join(f'{f}: {FIELDS[f][0]}' for f in fields)}>").fields])

    def code(texts: list[str | None]) -> pa.StructArray:
        to = codec(path)
        packed = [to.encode(t) if t else b"" for t in texts]
        out = {}
        if "packed" in fields:
            out["packed"] = pa.array(packed, pa.binary())
        if "decoded" in fields:
            out["decoded"] = pa.array([to.decode(np.frombuffer(p, "<u4")) for p in packed], pa.string())
        if "ids" in fields:
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))
        return pa.StructArray.from_arrays([out[f] for f in fields], list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], code(part.column(len(others)).to_pylist())], [*others, into])
        codec(path).forget()  # a worker may wait long for its next task
        give_back_memory()

    return df.select(*others, text).mapInArrow(run, kind)


def decoded(path: str):
    """A column function: ``array<int>`` to text; null and empty give an empty text, an unknown
    id fails."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        to = codec(path)
        lists = (i.values.to_numpy(zero_copy_only=False) if i.is_valid else np.zeros(0, np.int32) for i in ids)
        return pa.array([to.decode(i) for i in lists], pa.string())

    return decode
