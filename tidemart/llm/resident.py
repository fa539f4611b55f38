"""The one large object that a Python worker keeps from task to task.

Spark reuses its Python workers, also between operators. Vocabularies with their caches are worth
keeping while the same operator runs, and are let go when another one comes. What is let go of goes
back to the system: idle workers count against an executor's memory as well.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_held: dict[Hashable, Any] = {}


def keep(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave for ``key``; anything held for another key is let go first."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """For operators that keep nothing."""
    if _held:
        _held.clear()
        gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory, which allocators hold on to, to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None
