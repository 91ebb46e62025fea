"""Memory of jobs given as Python functions."""

import tracemalloc

import pyarrow as pa

from tessella.operators import keyed_jobs


def test_a_batch_becomes_python_objects_in_parts():
    words = [[f"word {i} {j}" for j in range(100)] for i in range(5_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(5_000)]), pa.array(words)], ["k", "v"])
    tracemalloc.start()
    n = sum(len(v) for _, v in keyed_jobs._python_rows([batch, batch.slice(0, 0)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 500_000
    assert peak < 20 << 20  # the whole batch takes 35 MB or more
    assert [*keyed_jobs._python_rows([batch])] == [*zip(range(5_000), words)]
