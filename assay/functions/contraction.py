"""Shrinks the edges inside one task before any of them is shuffled."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from assay.functions.chunks import by_chunks, ranked

# The function travels to the executors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Edges a task holds at a time.
HELD_ROWS = 200_000


def _stars(edges: pa.Table) -> pa.RecordBatch:
    """Edges (hi, lo) replaced by one edge from every node to the smallest node it is linked to."""
    ids, (a, b) = ranked(edges.column("hi"), edges.column("lo"))
    label = np.arange(len(ids))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        # the present labels of both ends, then the ends, take the lower one
        for at in (label[a], label[b], a, b):
            np.minimum.at(label, at, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    leaf = np.nonzero(label < np.arange(len(ids)))[0]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(leaf)), ids.take(pa.array(label[leaf]))], ["hi", "lo"])


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Same components with at most one edge per node and chunk, so a combiner for components."""
    return by_chunks(batches, _stars, HELD_ROWS)
