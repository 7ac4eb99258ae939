"""What reused Python workers keep between tasks: the caches of one operator at a time."""

from __future__ import annotations

import gc

import pyarrow as pa

_live: dict[str, dict] = {}


def only(owner: str, cache: dict) -> dict:
    """`cache`, after emptying those of other operators: a worker that goes on to the next
    stage of a pipeline gives back what the stages before it filled."""
    others = [name for name in _live if name != owner]
    for name in others:
        _live.pop(name).clear()
    _live[owner] = cache
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    return cache
