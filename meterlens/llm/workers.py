"""What Spark's Python processes hold between tasks.

Tasks of all queries run in the same few processes of an executor, whose memory is counted with
it. A process keeps what an operator left in it and what the C library and Arrow have freed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]
_HELD: dict[str, Any] = {}


def held(key: str, make: Callable[[], Any]) -> Any:
    """The process's own object under ``key``, made at its first use."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def drop_others(key: str | None) -> None:
    """Let go of what is held under other keys."""
    others = [k for k in _HELD if k != key]
    for k in others:
        del _HELD[k]
    if others:
        give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(read: Callable[[Batches], Batches], key: str | None = None) -> Callable[[Batches], Batches]:
    """``read`` for ``mapInArrow``, in a process without other operators' leavings.

    Objects held under other keys than ``key`` go before the task, freed memory after it.
    """
    def task(batches: Batches) -> Batches:
        drop_others(key)
        try:
            yield from read(batches)
        finally:
            give_back()

    return task
