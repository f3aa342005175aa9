"""What Python workers hold between tasks.

Spark hands a worker from task to task and from stage to stage, and one that waits keeps its memory beside the executor's heap
for a minute. So a worker keeps state of one kind only, a task gives back what it has freed, and a worker that no task reaches for
some seconds lets go of all: a later stage with fewer tasks than workers never comes to the others.
"""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa

#: Seconds without a task after which a worker lets go of what it keeps.
WAIT = 3.0

_kept: dict[Hashable, Any] = {}
_timer: threading.Timer | None = None
_lock = threading.RLock()


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """State that this worker keeps for later tasks with the same key; what it kept under another key goes first."""
    with _lock:
        if key not in _kept:
            let_go()
            _kept[key] = make()
        return _kept[key]


def let_go() -> None:
    with _lock:
        if _kept:
            _kept.clear()
            give_back()


def _begin() -> None:
    global _timer
    with _lock:
        if _timer:
            _timer.cancel()
        _timer = None


def _end() -> None:
    global _timer
    _begin()
    with _lock:
        if _kept:
            _timer = threading.Timer(WAIT, _waited)
            _timer.daemon = True
            _timer.start()


def _waited() -> None:
    with _lock:
        if threading.current_thread() is _timer:  # no task has begun meanwhile
            let_go()


def give_back() -> None:
    """Return freed memory to the system: the allocators would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that lets go of other operators' state first (unless it keeps some) and gives memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        if not keeps:
            let_go()
        try:
            yield from run(batches)
        finally:
            give_back()
            _end()

    return task
