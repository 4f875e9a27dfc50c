"""What tasks in Python workers have in common."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker waits for other tasks with what it
    holds, beside those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function over batches that gives memory back after each of them."""

    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        for result in function(batches):
            yield result
            give_back()

    return run
