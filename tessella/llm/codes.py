"""Short codes for vectors: each of a vector's parts is named by the nearest entry of a codebook.

Components become integers, floor(scale x), and all that follows is exact.  Parts and entries are
padded with zeros to a power of two p and put through the integer Walsh-Hadamard transform, which
multiplies every squared distance by p.  Its coefficients are taken in sequency order, the slow
ones first.  The first coefficient gives each part a likely entry, whose whole distance is a limit;
squared differences are added coefficient by coefficient, and entries above the limit drop out.
What is left at the end holds all entries at the least distance, of which the lowest index counts.

Arithmetic is in 32-bit or 64-bit integers where no sum can pass them, else in Python's.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most integers in all codebooks together; they are sent to every task.
CODEBOOK_CELLS = 4_000_000

#: Parts whose distances are held at once.
ROWS_AT_ONCE = 2048

_LIMB = 40
_LARGEST = 2**63 - 1


def sequency(p: int) -> np.ndarray:
    """Natural index of the Walsh function with 0, 1, .. p-1 changes of sign."""
    n = np.arange(p)
    gray, out = n ^ (n >> 1), np.zeros(p, np.int64)
    for bit in range(p.bit_length() - 1):
        out = out * 2 + (gray >> bit & 1)
    return out


def walsh(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the last axis, of a power-of-two length, in sequency order."""
    p, step = x.shape[-1], 1
    while step < p:
        pairs = x.reshape(*x.shape[:-1], p // (2 * step), 2, step)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        x = np.stack([a + b, a - b], axis=-2).reshape(x.shape)
        step *= 2
    return x[..., sequency(p)]


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x) of finite doubles; int64 if all fit 40 bits, else Python integers."""
    if not len(values) or np.abs(values).max() < 2.0**40 / scale:
        return np.floor(values * scale).astype(np.int64)
    # a double of 2**53 or more is whole
    return np.array([math.floor(v * scale) if abs(v) < 2.0**53 else int(v) * scale for v in values.tolist()], object)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of, and squared distance to, the nearest entry of each part; ties to the lower index."""
    m = parts.shape[1]
    p = 1 << max(0, m - 1).bit_length()
    top = max((int(abs(x).max()) for x in (parts, entries) if x.size), default=0)
    most = 4 * p * p * max(top, 1) ** 2  # no sum of squares is above this
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**62 else object
    spread = lambda x: walsh(np.concatenate([x, np.zeros((len(x), p - m), x.dtype)], axis=1).astype(kind))
    c = spread(entries)
    index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), object if kind is object else np.int64)
    for lo in range(0, len(parts), ROWS_AT_ONCE):
        x = spread(parts[lo : lo + ROWS_AT_ONCE])
        total = (x[:, :1] - c[None, :, 0]) ** 2  # the slowest coefficient, of all entries
        likely = total.argmin(axis=1)
        limit = ((x - c[likely]) ** 2).sum(axis=1, dtype=kind)
        left = np.flatnonzero((total <= limit[:, None]).astype(bool))
        row, entry, total = left // len(c), left % len(c), total.ravel()[left]
        for k in range(1, p):
            apart = x[:, k].take(row) - c[:, k].take(entry)
            total += apart * apart
            near = np.flatnonzero((total <= limit.take(row)).astype(bool))
            row, entry, total = row.take(near), entry.take(near), total.take(near)
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(total, starts)
        hits = np.flatnonzero((total == least[row]).astype(bool))
        index[lo : lo + len(x)] = entry[hits[np.searchsorted(row[hits], np.arange(len(x)))]]
        distance[lo : lo + len(x)] = least // p
    return index, distance


@dataclass(frozen=True)
class Codebooks:
    """For each width of vectors ``parts x entries x part length`` integers."""

    books: dict[int, np.ndarray]
    parts: int
    scale: int

    def digest(self, width: int) -> str:
        """SHA-256 of all components as decimals by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books[width].ravel().tolist())).encode()).hexdigest()

    def cut(self, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``width, rows, parts``: vectors of one width as ``rows x parts x part length`` integers."""
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == width)
            values = vectors.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            numbers = whole_numbers(values, self.scale).reshape(len(rows), width)
            short = -width % self.parts
            numbers = np.concatenate([numbers, np.zeros((len(rows), short), numbers.dtype)], axis=1)
            yield width, rows, numbers.reshape(len(rows), self.parts, (width + short) // self.parts)


def usable(vector: str):
    """Whether the vector is not null and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite)
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(False))


def _sums(books: Codebooks):
    """Per task: count and sum of the parts nearest to each entry.  Sums are split in limbs of 40
    bits, so that adding up those of all tasks stays within 64 bits."""

    def sums(batches):
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            for width, _, numbers in books.cut(batch.column(0)):
                for part in range(books.parts):
                    own = numbers[:, part]
                    index, _ = nearest(own, books.books[width][part])
                    order = np.argsort(index, kind="stable")
                    entries, starts = np.unique(index[order], return_index=True)
                    if (width, part) not in totals:
                        shape = books.books[width].shape[1:]
                        totals[width, part] = [np.zeros(shape[0], np.int64), np.zeros(shape, object)]
                    counts, added = totals[width, part]
                    counts += np.bincount(index, minlength=len(counts))
                    if own.shape[1]:
                        added[entries] = added[entries] + np.add.reduceat(own[order], starts, axis=0).astype(object)
        rows = []
        for (width, part), (counts, added) in totals.items():
            for entry in np.flatnonzero(counts).tolist():
                rows.append((width, part, entry, -1, 0, int(counts[entry])))
                for position, value in enumerate(added[entry].tolist()):
                    limb = 0
                    while abs(value) >> _LIMB:
                        value, low = divmod(int(value), 1 << _LIMB)
                        rows.append((width, part, entry, position, limb, low))
                        limb += 1
                    rows.append((width, part, entry, position, limb, int(value)))
        columns = list(zip(*rows)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["width", "part", "entry", "position", "limb", "value"])

    return sums


def fit(vectors: DataFrame, vector: str, key: str, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks:
    """Codebooks of every width of vector in the table, from all its usable rows.

    Entries begin as the parts of the ``entries`` rows with the smallest keys (of rows that repeat a
    key, smaller vectors first; null keys last); fewer rows give fewer entries.  A round assigns
    every part to its nearest entry and replaces each entry that has parts by the floor of their mean.
    A width that ``parts`` does not divide is filled with zeros.  The codebooks are the only thing
    that reaches the driver, and hold at most ``CODEBOOK_CELLS`` integers, else ValueError.
    """
    rows = vectors.where(usable(vector)).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    widths = rows.select(F.size("v").alias("w")).distinct()
    cells = widths.agg(F.sum(F.ceil(F.col("w") / parts) * parts * entries)).first()[0] or 0
    if cells > CODEBOOK_CELLS:
        raise ValueError(f"codebooks of {cells} integers are above the limit of {CODEBOOK_CELLS}")
    smallest = Window.partitionBy(F.size("v")).orderBy(F.col("key").asc_nulls_last(), "v")
    seeds = rows.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= entries)
    seeds = seeds.orderBy("nth").select("v").toArrow()
    blank = Codebooks({}, parts, scale)
    books = Codebooks({w: n.transpose(1, 0, 2) for w, _, n in blank.cut(seeds.column("v"))}, parts, scale)
    for _ in range(rounds if books.books else 0):
        partial = rows.select("v").mapInArrow(_sums(books), "width long, part long, entry long, position long, limb long, value long")
        found: dict[tuple, int] = {}
        for r in partial.groupBy("width", "part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():
            at = (r.width, r.part, r.entry, r.position)
            found[at] = found.get(at, 0) + (r.value << _LIMB * r.limb)
        moved = {w: b.astype(object) for w, b in books.books.items()}
        for (width, part, entry, position), value in found.items():
            if position >= 0:
                moved[width][part, entry, position] = value // found[width, part, entry, -1]
        books = Codebooks({w: _narrow(b) for w, b in moved.items()}, parts, scale)
    return books


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """64-bit integers if all fit 40 bits."""
    return numbers.astype(np.int64) if max((abs(v) for v in numbers.ravel().tolist()), default=0) < 1 << 40 else numbers


def coded(books: Codebooks):
    """A column function: vector to ``code binary, error long``: one byte a part (an entry's index,
    so codebooks of at most 256 entries) and the squared distances summed over parts.  Null for
    vectors that are not usable.  An error above the largest long is given as that."""

    def code(vectors: pa.Array) -> pa.Array:
        codes, errors = [None] * len(vectors), [None] * len(vectors)
        for width, rows, numbers in books.cut(vectors.fill_null([])):
            if width not in books.books:
                continue  # only rows that are not usable
            found = [nearest(numbers[:, part], books.books[width][part]) for part in range(books.parts)]
            named = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            for at, name, *distances in zip(rows.tolist(), named, *(d.tolist() for _, d in found)):
                codes[at], errors[at] = name.tobytes(), min(sum(distances), _LARGEST)
        return pa.StructArray.from_arrays([pa.array(codes, pa.binary()), pa.array(errors, pa.int64())], ["code", "error"])

    return F.arrow_udf(code, "code binary, error long")


def compress(vectors: DataFrame, books: Codebooks, vector: str, into: str = "coded") -> DataFrame:
    """Usable rows of ``vectors`` with a struct ``into (code, error, books)``, ``books`` the digest of
    the codebooks in use.  Rows that repeat stay; an empty table stays empty; other columns pass,
    whatever their names, but one called ``into``, which is replaced."""
    rows = vectors.where(usable(vector))
    found = coded(books)(F.col(vector).cast("array<double>"))
    digests = [x for w in books.books for x in (F.lit(w), F.lit(books.digest(w)))]
    digest = F.create_map(*digests)[F.size(vector)] if digests else F.lit(None).cast("string")
    return rows.withColumn(into, F.struct(found["code"].alias("code"), found["error"].alias("error"), digest.alias("books")))


def decoded(books: Codebooks, width: int, code: bytes) -> np.ndarray:
    """The integers a code stands for, without the zeros that filled the last parts."""
    return np.concatenate([books.books[width][part, entry] for part, entry in enumerate(code)])[:width]
