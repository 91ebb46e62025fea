"""Arithmetic on fixed-length numeric arrays."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda acc, x: acc + x
    )


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean norm of ``a - b``."""

    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda acc, x: acc + x))


def vector_literal(values: Sequence[float]) -> Column:
    """A constant ``array<double>``; one text literal that the optimizer folds once."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def standardize(x: Column, mean: Column, scale: Column) -> Column:
    """``(x - mean) / scale`` element by element."""
    centred = F.zip_with(x, mean, lambda v, mu: v.cast("double") - mu)
    return F.zip_with(centred, scale, lambda v, s: v / s)
