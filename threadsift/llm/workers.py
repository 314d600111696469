"""What a Python worker keeps between tasks, and how it gives memory back."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_kept: dict[Hashable, object] = {}


def kept(key: Hashable, build: Callable[[], object]):
    """The value under ``key``, built once per worker; a worker keeps one value at a time."""
    if key not in _kept:
        release()
        _kept[key] = build()
    return _kept[key]


def release() -> None:
    """Drops what is kept and hands freed memory back to the system, for a task that needs much of it: workers outlive
    tasks, and an executor's memory holds all of its workers."""
    _kept.clear()
    trim()


def trim() -> None:
    """Hands freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
