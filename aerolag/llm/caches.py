"""What worker processes keep between tasks, and when they let go of it.

Python workers outlive a stage. Stores of words or models that help the tasks of one operator would stay in
memory while others run, so a worker drops them all when it starts a task of another operator.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_drops: list[Callable[[], None]] = []
_last: str | None = None


def drops(function: Callable[[], None]) -> Callable[[], None]:
    """Register what empties a store of this process."""
    _drops.append(function)
    return function


def begin(operator: str) -> None:
    """A task of ``operator`` starts: drop all stores if the last one was of another."""
    global _last
    if _last is not None and _last != operator:
        for drop in _drops:
            drop()
        gc.collect()
        release()
    _last = operator


def release() -> None:
    """Give memory that is free back to the machine: allocators keep it, and idle workers would for good."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
