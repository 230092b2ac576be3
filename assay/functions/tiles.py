"""All pairs of one tile of profiles, scored and summed where they are, so that no list of them exists."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from assay.functions.chunks import give_back, ranked
from assay.functions.similarity import similarity_grid

# The function travels to the executors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows and columns looked at together; these bound the work arrays whatever a tile holds.
PANEL = 1024
STRIPE = 64
# Similarities of the distinct texts of a tile that are held for all of its panels: 32 MB.
HELD = 1 << 22

SUMS = "id string, others bigint, mass double, lo string"


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place each place is linked to, after the links (a, b) come to those in ``label``."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]


def _coded(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Its distinct values, and which one each row has; -1 for null."""
    values = column.combine_chunks().dictionary_encode()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    return values.dictionary, values.indices.fill_null(-1).to_numpy().astype(np.int64)


def _alike(code: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    """Which rows of ``left`` (rows) and ``right`` (columns) have the same value, no nulls; None if none have."""
    x, y = code[left], np.where(code[right] < 0, -2, code[right])
    return x[:, None] == y if np.isin(x, y).any() else None


class _Texts:
    """Similarities of the texts of one column between stretches of a tile's rows.

    They are looked up among those of all distinct texts where these are few, otherwise found stretch by stretch.
    """

    def __init__(self, column: pa.ChunkedArray, left: np.ndarray, right: np.ndarray) -> None:
        values, code = _coded(column)
        self.code = np.where(code < 0, len(values), code)  # null is similar to nothing, like an empty text
        self.values = np.array([*values.to_pylist(), ""], object)
        self.held = None
        (u, x), (v, y) = self._distinct(left), self._distinct(right)
        if len(u) * len(v) <= HELD:
            self.held = self._grid(u, v)
            self.row, self.column = np.zeros((2, len(code)), np.int64)
            self.row[left], self.column[right] = x, y

    def _distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.code[rows], return_inverse=True)

    def _grid(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return similarity_grid(self.values[u].tolist(), self.values[v].tolist())

    def between(self, left: np.ndarray, right: np.ndarray) -> Callable[[int, int], np.ndarray]:
        """Function that gives the similarities of the rows lo to hi of ``left`` with all of ``right``."""
        if self.held is not None:
            grid, x, y = self.held, self.row[left], self.column[right]
        else:
            (u, x), (v, y) = self._distinct(left), self._distinct(right)
            grid = self._grid(u, v)
        return lambda lo, hi: grid[x[lo:hi]].take(y, axis=1)


def tile_sums(
    attributes: list[tuple[str, bool, float]], routes: list[tuple[str, ...]], threshold: float, total: float
) -> Callable[[tuple, pa.Table], pa.Table]:
    """Function from one tile to (id, others, mass, lo) of the profiles that match any other one in it.

    ``attributes`` are (column, exact, weight), ``routes`` the columns two profiles must agree on, in order: a
    pair belongs to the first route on which it agrees. ``others`` and ``mass`` count the records matched
    and sum their confidences, ``lo`` is the smallest id that the matches of the tile lead to.
    """

    def run(key: tuple, tile: pa.Table) -> pa.Table:
        _, route, i, j = (k.as_py() for k in key)
        ids, (place,) = ranked(tile.column("id"))
        by = np.argsort(place)
        tile, side = tile.take(pa.array(by)), tile.column("side").to_numpy()[by]
        ids, n = tile.column("id"), tile.column("n").to_numpy().astype(float)
        # a chunk may be empty, so the right side of (i, i) is told by the numbers
        left = np.nonzero(side == 0)[0]
        right = left if i == j else np.nonzero(side == 1)[0]

        codes = {c: _coded(tile.column(c))[1] for c in {c for r in routes for c in r} | {c for c, exact, _ in attributes if exact}}
        texts = {c: _Texts(tile.column(c), left, right) for c, exact, _ in attributes if not exact}

        def agree(columns: tuple[str, ...]) -> np.ndarray:
            """One code for the values of all columns of a row, -1 if any is null."""
            known = np.logical_and.reduce([codes[c] >= 0 for c in columns])
            _, code = np.unique(np.stack([codes[c] for c in columns]), axis=1, return_inverse=True)
            return np.where(known, code.ravel(), -1)

        agreeing = [agree(columns) for columns in routes[: route + 1]]
        label, others, mass = np.arange(len(n)), np.zeros(len(n)), np.zeros(len(n))

        def panel(a: np.ndarray, b: np.ndarray, inside: bool) -> None:
            nonlocal label
            owned = [_alike(code, a, b) for code in agreeing]
            if owned[-1] is None:
                return
            terms = [(texts[c].between(a, b) if not exact else _alike(codes[c], a, b), exact, w) for c, exact, w in attributes]
            for lo in range(0, len(a), STRIPE):
                hi = min(lo + STRIPE, len(a))
                sure = np.zeros((hi - lo, len(b)))
                for term, exact, weight in terms:
                    if term is not None:
                        part = term[lo:hi].astype(float) if exact else term(lo, hi)
                        part *= weight
                        sure += part
                sure /= total
                met = sure >= threshold
                met &= owned[-1][lo:hi]
                for earlier in owned[:-1]:
                    if earlier is not None:
                        met &= ~earlier[lo:hi]
                if inside:  # each pair once
                    met &= np.arange(len(b)) > np.arange(lo, hi)[:, None]
                sure *= met
                counted = met.astype(float)
                x = a[lo:hi]
                others[x] += counted @ n[b]
                others[b] += n[x] @ counted
                mass[x] += sure @ n[b]
                mass[b] += n[x] @ sure
                apart = label[x][:, None] != label[b]
                if apart.any():
                    apart &= met
                    p, q = np.nonzero(apart)
                    if len(p):
                        label = join_labels(label, x[p], b[q])

        for r in range(0, len(left), PANEL):
            for s in range(r if i == j else 0, len(right), PANEL):
                panel(left[r : r + PANEL], right[s : s + PANEL], i == j and r == s)
        if len(left) * len(right) > PANEL * PANEL:
            give_back()
        linked = pa.array(np.nonzero(others > 0)[0])
        return pa.table(
            {
                "id": ids.take(linked),
                "others": pa.array(others.astype(np.int64)).take(linked),
                "mass": pa.array(mass).take(linked),
                "lo": ids.take(pa.array(label)).take(linked),
            }
        )

    return run
