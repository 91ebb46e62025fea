"""Hashed signatures of feature vectors and their banding, without any UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.lambdas import bind, indices

MAX_BAND_BITS = 62


def feature_chunks(features: Column, m: int = 128, cover_tail: bool = False) -> Column:
    """Array of chunks, one per signature bit.

    When ``m`` divides the length there are ``m`` plain chunks.  Otherwise ``m // 2``
    chunks of ``2 * (length // m)`` run forward from the start and as many backward from
    the end; the backward ones stop one short of the last element unless ``cover_tail``.
    """
    half = m // 2
    shift = 1 if cover_tail else 0

    def cut(f: Column) -> Column:
        return bind(_div(F.size(f), m), lambda step: chunks(f, step))

    def chunks(f: Column, step: Column) -> Column:
        n = F.size(f)
        wide = step * 2
        plain = F.transform(indices(F.lit(m)), lambda i: F.slice(f, i * step + 1, step))
        forward = F.transform(indices(F.lit(half)), lambda i: F.slice(f, i * wide + 1, wide))
        backward = F.transform(
            indices(F.lit(half)), lambda i: F.slice(f, n - (i + 1) * wide + shift, wide)
        )
        too_short = F.raise_error(F.concat(F.lit(f"a signature of {m} bits needs at least {m} features, got "), n))
        return (
            F.when(step < 1, too_short.cast("array<array<string>>"))
            .when(n % m == 0, plain)
            .otherwise(F.concat(forward, backward))
        )

    return bind(features, cut)


def _div(x: Column, n: int) -> Column:
    return F.floor(x / F.lit(n)).cast("int")


def chunk_bit(text: Column) -> Column:
    """63rd binary digit, leading zeros not counted, of the md5 of ``text``.

    With leading zero nibbles gone, the first nibble holds one to four digits, so the
    wanted digit sits at a fixed place of the 16th or 17th nibble.
    """

    def pick(h: Column) -> Column:
        first, n16, n17 = F.substring(h, 1, 1), F.substring(h, 16, 1), F.substring(h, 17, 1)
        return (
            F.when(first >= "8", F.contains(F.lit("2367abef"), n16))
            .when(first >= "4", F.contains(F.lit("13579bdf"), n16))
            .when(first >= "2", n17 >= "8")
            .otherwise(F.contains(F.lit("4567cdef"), n17))
            .cast("tinyint")
        )

    return bind(F.ltrim(F.md5(text), F.lit("0")), pick)


def signature(features: Column, m: int = 128, cover_tail: bool = False) -> Column:
    """``m`` bits, one per chunk of the feature vector written as ``[a, b, ..]``."""
    chunks = feature_chunks(features.cast("array<string>"), m, cover_tail)
    return F.transform(
        chunks,
        lambda c: chunk_bit(F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))),
    )


def band_values(bits: Column, m: int, b: int = 11) -> Column:
    """The first ``(m // b) * b`` bits as ``m // b`` binary numbers of ``b`` bits each."""
    if not 1 <= b <= MAX_BAND_BITS:
        raise ValueError(f"band size must be between 1 and {MAX_BAND_BITS}, got {b}")
    if b > m:
        raise ValueError(f"a band of {b} bits is wider than the signature of {m} bits")
    return bind(
        bits,
        lambda s: F.transform(
            indices(F.lit(m // b)),
            lambda i: F.aggregate(
                F.slice(s, i * b + 1, b),
                F.lit(0).cast("bigint"),
                lambda acc, x: acc * 2 + x.cast("bigint"),
            ),
        ),
    )


def band_buckets(bits: Column, m: int, b: int = 11) -> Column:
    """``array<struct<band int, bucket bigint>>`` of a signature."""
    return F.transform(
        band_values(bits, m, b),
        lambda v, i: F.struct(i.cast("int").alias("band"), v.alias("bucket")),
    )
