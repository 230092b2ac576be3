"""Edges a task holds at a time as small numbers, and what it does with its memory afterwards."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The functions travel to the executors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes a task holds at a time, beside a number of rows; they bound its memory whatever the partition size.
HELD_BYTES = 16 << 20


def ranked(*columns: pa.ChunkedArray) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct values of all columns in order, and each column as places in them; no value becomes an object."""
    coded = pa.chunked_array([c for column in columns for c in column.chunks], columns[0].type).dictionary_encode()
    coded = coded.combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    order = pc.array_sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    codes = place[coded.indices.to_numpy()]
    ends = np.cumsum([len(column) for column in columns])[:-1]
    return coded.dictionary.take(order), np.split(codes, ends)


def by_chunks(
    batches: Iterator[pa.RecordBatch], reduced: Callable[[pa.Table], pa.RecordBatch], most_rows: int
) -> Iterator[pa.RecordBatch]:
    """``reduced`` of every chunk of the rows; a worker then gives unused memory back, since Spark keeps workers."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most_rows or size >= HELD_BYTES:
            yield reduced(pa.Table.from_batches(held))
            held, rows, size = [], 0, 0
    if rows:
        yield reduced(pa.Table.from_batches(held))
    held.clear()
    give_back()


def give_back() -> None:
    """Return unused memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only one C library has it
        pass
