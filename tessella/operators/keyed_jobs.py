"""Jobs given as a Python map and reduce function, run on Spark's own shuffle."""

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Distinct keys a map task may hold before it hands its combined values on.
HELD_KEYS = 200_000

#: Values of one key a map task may hold before it combines them.
HELD_VALUES = 256

#: Values of all keys a map task may hold before it combines them.
HELD_PAIRS = 1_000_000

#: Bytes of an Arrow batch that are Python objects at a time; these take ten times as much or more.
SLICE_BYTES = 1 << 20

_FLUSH_ROWS = 20_000


def map_reduce(
    df: DataFrame,
    map_fn: Callable[[Any, Any], Iterable[tuple[Any, Any]]],
    combine_fn: Callable[[Any, list], list],
    reduce_fn: Callable[[Any, list], tuple | None],
    pair_schema: str,
    out_schema: str,
    slices: int = 16,
) -> DataFrame:
    """Run ``map_fn(k, v) -> [(k2, v2)]`` and ``reduce_fn(k2, [v2]) -> row or None``.

    ``df`` has two columns, key and value; ``pair_schema`` types the mapped pair and
    ``out_schema`` the reduced row.  A None from ``reduce_fn`` gives no row.

    ``combine_fn(k2, [v2]) -> [v2]`` shortens a list of values, to a length that does not
    grow with the list, without changing what ``reduce_fn`` makes of it together with
    further values: ``lambda k, vs: [sum(vs)]`` for a sum.  It runs in the map tasks and
    again on ``slices`` parts of each key, so no task ever holds all values of a hot key.
    A batch becomes Python objects ``SLICE_BYTES`` at a time, so a worker's memory does not grow
    with the rows of a partition.
    """
    names = T._parse_datatype_string(pair_schema).fieldNames()
    if len(names) != 2:
        raise ValueError(f"pair_schema must have two columns, got {names}")
    key, value = names

    def run_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        added = 0
        for k, v in _python_rows(batches):
            for k2, v2 in map_fn(k, v):
                values = held.setdefault(k2, [])
                values.append(v2)
                added += 1
                if len(values) >= HELD_VALUES:
                    held[k2] = list(combine_fn(k2, values))
            if len(held) > HELD_KEYS or added > HELD_PAIRS:
                many = len(held) > HELD_KEYS
                if not many:
                    held = {k2: list(values) for k2, values in combined(held.items())}
                    many = sum(map(len, held.values())) > HELD_PAIRS // 2
                if many:
                    yield from _pairs(combined(held.items()), pair_arrow)
                    held = {}
                added = sum(map(len, held.values()))
        yield from _pairs(combined(held.items()), pair_arrow)

    def combined(items: Iterable[tuple[Any, list]]) -> Iterator[tuple[Any, list]]:
        for k, values in items:
            yield k, values if len(values) == 1 else combine_fn(k, values)

    def run_combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pairs(combined(_python_rows(batches)), pair_arrow)

    def run_reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (reduce_fn(k, vs) for k, vs in _python_rows(batches))
        yield from _rows((row for row in rows if row is not None), out_arrow)

    pair_arrow = to_arrow_schema(T._parse_datatype_string(pair_schema))
    out_arrow = to_arrow_schema(T._parse_datatype_string(out_schema))

    pairs = df.mapInArrow(run_map, pair_schema)
    if slices > 1:
        sliced = pairs.groupBy(key, F.pmod(F.spark_partition_id(), F.lit(slices)).alias("slice"))
        grouped = sliced.agg(F.collect_list(value).alias("values")).select(key, "values")
        pairs = grouped.mapInArrow(run_combine, pair_schema)
    grouped = pairs.groupBy(key).agg(F.collect_list(value).alias("values"))
    return grouped.mapInArrow(run_reduce, out_schema)


def _python_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of ``batches``, of which some ``SLICE_BYTES`` at a time are Python objects."""
    for batch in batches:
        step = max(1, SLICE_BYTES * batch.num_rows // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield from zip(*(column.to_pylist() for column in batch.slice(i, step).columns))


def _pairs(items: Iterable[tuple[Any, list]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    return _rows(((k, v) for k, vs in items for v in vs), schema)


def _rows(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    buffer: list[tuple] = []
    for row in rows:
        buffer.append(row)
        if len(buffer) >= _FLUSH_ROWS:
            yield _batch(buffer, schema)
            buffer = []
    if buffer:
        yield _batch(buffer, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
