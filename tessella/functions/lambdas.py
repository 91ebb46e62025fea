"""Small helpers for higher-order functions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand the result to ``body``.

    Catalyst folds neighbouring projections together, so an expensive column that is
    mentioned inside a lambda would otherwise be evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(array: Column) -> Column:
    """The same array, as an expression to explode when it is computed on the fly.

    Below the explode of a plain column Spark adds a not-empty filter on that column, which
    is then pushed down and computes the array a second time.
    """
    return F.flatten(F.array(array))


def indices(n: Column) -> Column:
    """``[0, 1, .., n-1]``, empty when ``n`` is zero or less."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
