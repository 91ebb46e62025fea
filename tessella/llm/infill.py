"""Fill-in-the-middle: cut texts at word ends found in 64-bit words, and put the pieces in a new order.

A unit is a run of ASCII white space with the word after it, or the white space that ends the
text.  The UTF-8 bytes of a batch lie in one buffer, every text from a multiple of eight on and
followed by at least one space, and are read as unsigned 64-bit words.  Arithmetic on whole words
leaves the high bit of each byte that ends a unit.  The running sum of the bits set in the words
finds the word that holds the n-th end, and the running sum of its bytes, by one multiplication,
the byte.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import text_arrays

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Bytes of text that share one buffer; a longer text has its own.
BUFFER = 4 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_SEVEN = ~_HIGH


def _all(byte: int) -> np.uint64:
    """The same value in each of the eight bytes."""
    return np.uint64(byte * int(_ONES))


def space_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is 0x20 or 0x09 to 0x0D.  No sum passes a byte's limit."""
    low = words & _SEVEN
    from_tab = low + _all(0x80 - 0x09)
    past_return = low + _all(0x80 - 0x0E)
    differs = words ^ _all(0x20)
    not_blank = ((differs & _SEVEN) + _SEVEN) | differs
    return ((from_tab & ~past_return & ~words) | ~not_blank) & _HIGH


def lead_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a character."""
    return ~(words & ~(words << np.uint64(1))) & _HIGH


class Marked:
    """Texts of one buffer with the ends of their units."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        self.first = np.concatenate([[0], np.cumsum(lengths // 8 + 1)])  # word where each text starts
        raw = np.full(int(self.first[-1]) * 8, 0x20, np.uint8)
        for i in np.flatnonzero(lengths):
            start = int(self.first[i]) * 8
            raw[start : start + int(lengths[i])] = data[offsets[i] : offsets[i + 1]]
        self.words = raw.view("<u8")
        spaces = space_marks(self.words)
        after = spaces >> np.uint64(8)
        after[:-1] |= spaces[1:] << np.uint64(56)
        self.ends = ~spaces & after & _HIGH
        last = (self.first[:-1] * 8 + lengths - 1)[lengths > 0]
        last = last[spaces.view(np.uint8)[last] != 0]  # white space at a text's end is a unit
        self.ends.view(np.uint8)[last] = 0x80
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)])
        self.leads = lead_marks(self.words)
        self.chars = np.concatenate([[0], np.cumsum(np.bitwise_count(self.leads), dtype=np.int64)])

    def units(self) -> np.ndarray:
        """Number of units of each text."""
        return np.diff(self.counts[self.first])

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """Bytes of each text up to the end of its ``unit``-th unit, from 1; 0 gives 0."""
        start = self.first[:-1]
        some = np.flatnonzero(unit > 0)
        rank = self.counts[start[some]] + unit[some]
        word = np.searchsorted(self.counts, rank) - 1
        within = (rank - self.counts[word]).astype(np.uint64)
        running = (self.ends[word] >> np.uint64(7)) * _ONES  # in byte i: ends in bytes 0 to i
        reached = ((running | _HIGH) - within * _ONES) & _HIGH
        out = np.zeros(len(unit), np.int64)
        out[some] = (word - start[some]) * 8 + 9 - np.bitwise_count(reached)
        return out

    def chars_before(self, end: np.ndarray) -> np.ndarray:
        """Characters of each text in its first ``end`` bytes."""
        start = self.first[:-1]
        word = start + end // 8
        inside = (np.uint64(1) << (end % 8 * 8).astype(np.uint64)) - np.uint64(1)
        return self.chars[word] + np.bitwise_count(self.leads[word] & inside) - self.chars[start]


def _buffers(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts that share a buffer."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BUFFER, "right")) - 1)
        yield lo, hi
        lo = hi


_CUTS = ["n", "prefix_end", "middle_end", "prefix_chars", "middle_chars"]


def _cut_batch(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Where the texts are cut: after the smaller and the larger of two draws of 0 to n units."""
    data, offsets = text_arrays(text)
    draws = [np.asarray(d.to_numpy(zero_copy_only=False), np.int64) for d in (one, two)]
    parts = [np.zeros((len(_CUTS), 0), np.int64)]
    for lo, hi in _buffers(offsets):
        marked = Marked(data, offsets[lo : hi + 1])
        n = marked.units()
        first, second = (d[lo:hi] % (n + 1) for d in draws)
        prefix, middle = marked.end_of(np.minimum(first, second)), marked.end_of(np.maximum(first, second))
        chars = marked.chars_before(prefix)
        parts.append(np.stack([n, prefix, middle, chars, marked.chars_before(middle) - chars]))
    return pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(parts, axis=1)], _CUTS)


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 42, share: int = 50, spm: int = 80, into: str = "infill") -> DataFrame:
    """``docs`` with a struct ``into (n, form, prefix_chars, middle_chars, output)``.

    A text of ``n`` units is cut after two drawn numbers of units into prefix, middle and suffix.
    ``share`` percent of the texts are put in a new order: of these ``spm`` percent as form ``spm``,
    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, the others as ``psm``, ``<P>`` prefix ``<S>``
    suffix ``<M>`` middle.  The rest, empty texts, and texts that hold a mark stay as they are: form
    ``plain``, with null lengths.  The draws come from a hash of seed and key alone, so equal keys draw
    alike on every run; a null key counts as an empty string and a null text as an empty text.  Whole
    texts are cut, however long.  Rows that repeat stay; an empty table stays empty.  All other
    columns pass, whatever their names, but one called ``into``, which is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    cut = F.arrow_udf(_cut_batch, ", ".join(f"{c} long" for c in _CUTS))(whole, draw[0], draw[1])
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (draw[2] % 100 >= share)
    form = F.when(plain, "plain").when(draw[3] % 100 < spm, "spm").otherwise("psm")
    raw = whole.cast("binary")
    piece = lambda start, size: F.substring(raw, start + 1, size).cast("string")
    prefix = piece(F.lit(0), cut["prefix_end"].cast("int"))
    middle = piece(cut["prefix_end"].cast("int"), (cut["middle_end"] - cut["prefix_end"]).cast("int"))
    suffix = piece(cut["middle_end"].cast("int"), F.octet_length(whole))
    spm_output = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    psm_output = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    return docs.withColumn(
        into,
        F.struct(
            cut["n"].alias("n"),
            form.alias("form"),
            F.when(~plain, cut["prefix_chars"]).alias("prefix_chars"),
            F.when(~plain, cut["middle_chars"]).alias("middle_chars"),
            F.when(plain, whole).when(form == "spm", spm_output).otherwise(psm_output).alias("output"),
        ),
    )


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of.  No piece holds a mark, so the marks cut it in three."""
    pieces = F.split(output, "<[PSM]>", -1)
    at = lambda i: F.get(pieces, F.lit(i))
    return F.when(form == "plain", output).when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(F.concat(at(1), at(3), at(2)))
