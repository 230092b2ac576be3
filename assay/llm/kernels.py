"""Numpy helpers that run inside tasks over the bytes of many texts at once."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle

# Executors need numpy, pyarrow and xxhash, not this package: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text handled at a time, which bounds the memory of a task whatever a batch holds.
CHUNK_BYTES = 1 << 19
# Words remembered by a task before it starts anew.
HELD_WORDS = 1 << 17


def tidy(kernel):
    """``kernel``, after whose last batch a worker gives unused memory back: Spark keeps workers for later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # only one C library has it
            pass

    return run


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at.astype(np.int64) - at[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; a longer row is a run of its own."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(rows, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words64(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one little-endian number, zeros beyond the end."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    out = np.empty((n // 8 + 1) * 8, np.uint64)
    for shift in range(8):
        out[shift::8] = np.frombuffer(padded, "<u8", n // 8 + 1, shift)
    return out[:n]


class WordHashes(dict):
    """64-bit hashes of words, remembered while a task runs."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > HELD_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of the whole sequence when it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    last = len(words) - size + 1
    total = np.full(last, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + last]
    return mixed(total)
