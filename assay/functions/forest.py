"""Drops, inside one task, edges that no maximum spanning forest needs."""

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


def heaviest(u: np.ndarray, v: np.ndarray, place: np.ndarray, nodes: int) -> np.ndarray:
    """Which edges (u, v) are in the spanning forest that prefers edges of a low ``place``; places differ."""
    at = np.empty(len(place), np.int64)
    at[place] = np.arange(len(place))
    label, taken = np.arange(nodes), np.zeros(len(u), bool)
    while True:
        x, y = label[u], label[v]
        open_ = x != y
        if not open_.any():
            return taken
        best = np.full(nodes, len(place))
        np.minimum.at(best, x[open_], place[open_])
        np.minimum.at(best, y[open_], place[open_])
        own = np.nonzero(best < len(place))[0]
        edge = at[best[own]]
        taken[edge] = True
        parent = np.arange(nodes)
        parent[own] = np.where(x[edge] == own, y[edge], x[edge])
        # two that chose the same edge: the smaller one becomes the root
        both = (parent[parent] == np.arange(nodes)) & (np.arange(nodes) < parent)
        parent[both] = np.nonzero(both)[0]
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        label = parent[label]


def _reduced(edges: pa.Table) -> pa.RecordBatch:
    ids, (u, v) = ranked(edges.column("u"), edges.column("v"))
    _, (a, b) = ranked(edges.column("a"), edges.column("b"))
    n = len(u)
    by = np.lexsort((b, a, -edges.column("weight").to_numpy()))
    place = np.empty(n, np.int64)
    place[by] = np.arange(n)
    taken = heaviest(u, v, place, len(ids))
    return edges.take(pa.array(np.nonzero(taken)[0])).combine_chunks().to_batches()[0]


def forest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v, a, b, weight), fewer than nodes per chunk; what goes is the lightest edge of some cycle."""
    return by_chunks(batches, _reduced, HELD_ROWS)
