"""Scalar Python functions lifted to array columns."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def lift_over_arrays(df: DataFrame, column: str, fn: Callable, element_type: str) -> DataFrame:
    """``df`` with every element of an array column replaced by ``fn(element)``.

    For logic that has no built-in form; where built-ins suffice, ``F.transform`` stays in
    the JVM.  Works on whole Arrow batches and calls ``fn`` once per distinct value of one.
    NULL elements stay NULL and are not passed to ``fn``; integers of any size arrive exact.
    """
    element = T._parse_datatype_string(element_type)
    fields = [
        T.StructField(f.name, T.ArrayType(element) if f.name == column else f.dataType) for f in df.schema
    ]
    arrow_type = to_arrow_type(element)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            flat = lists.flatten().dictionary_encode()
            mapped = pa.array([fn(v) for v in flat.dictionary.to_pylist()], type=arrow_type).take(flat.indices)
            lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            out = pa.ListArray.from_arrays(offsets, mapped, mask=lists.is_null())
            at = batch.schema.get_field_index(column)
            columns = [out if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(run, T.StructType(fields))
