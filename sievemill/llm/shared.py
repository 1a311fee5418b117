"""What the corpus operators share: written intermediate tables and Arrow helpers."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from sievemill.sources.shared_tables import exists, new_path, only, remove, shared_dir, written

__all__ = ["exists", "free_name", "give_back", "groups_of", "new_path", "only", "ragged", "remove", "shared_dir", "text_views", "trimmed", "written"]


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no column has that name, case aside."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def give_back() -> None:
    """Give the memory of what was freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(run: Callable) -> Callable:
    """A generator that gives memory back when it ends: Python workers live on and serve other stages beside the JVM."""

    @functools.wraps(run)
    def inner(*args):
        try:
            yield from run(*args)
        finally:
            give_back()

    return inner


def text_views(column: pa.Array | pa.ChunkedArray) -> tuple[memoryview, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n, at = len(column), column.offset
    buffers = column.buffers()
    if n == 0 or buffers[1] is None:
        return memoryview(b""), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    if buffers[2] is None:
        return memoryview(b""), np.zeros(n + 1, np.int64)
    data = memoryview(buffers[2])[int(offsets[0]) : int(offsets[-1])]
    return data, offsets - offsets[0]


def groups_of(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges start .. start + length."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(ends[-1])
