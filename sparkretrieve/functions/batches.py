"""Arrow batches in Python tasks: bounded parts, and memory handed back."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute

PART_BYTES = 1 << 20


def parts_of(texts: pa.Array, max_bytes: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """(first, length) of consecutive parts of about ``max_bytes`` of text each:
    Spark sends up to 64 MB at once, of which Python objects take several times that."""
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64) + 16
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // max_bytes)) + 1
    bounds = [0, *cuts.tolist(), len(texts)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b > a:
            yield a, b - a


def release_free_memory() -> None:
    """Hands memory that earlier work of this process freed back to the system:
    workers are reused, and allocators keep what a former task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)
