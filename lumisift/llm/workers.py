"""What a Python worker remembers between tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa

_held: list[tuple[str, Callable[[], object]]] = []


def hold(name: str, forget: Callable[[], object]) -> None:
    """Called in a worker before an operator uses what it remembers. What another operator left is forgotten, so a
    worker that serves several of them in turn holds the memory of one."""
    if _held and _held[0][0] == name:
        return
    for _, drop in _held:
        drop()
    _held[:] = [(name, forget)]
    gc.collect()
    pa.default_memory_pool().release_unused()
