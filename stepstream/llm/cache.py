"""A bounded memory of what was computed for a key, private to one Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import pyarrow as pa

_HOME = "stepstream_worker_objects"


def in_worker(make: Callable, *key):
    """``make(*key)``, made once in a Python worker and kept for its later tasks.

    Functions reach a worker anew with each task, globals included, so these are no place to keep it.
    """
    kept = vars(sys.modules.setdefault(_HOME, types.ModuleType(_HOME)))
    name = repr((make.__qualname__, key))
    if name not in kept:
        kept[name] = make(*key)
    return kept[name]


def give_back() -> None:
    """At the end of a task: its worker lives on, and other stages need the room that Arrow holds for later batches."""
    pa.default_memory_pool().release_unused()


class Recent(dict):
    """Remembers ``compute(key)``; at ``most`` keys it starts anew, and takes keys that come back from the last lot."""

    def __init__(self, most: int, compute: Callable | None = None):
        super().__init__()
        self.most = most
        self.compute = compute
        self.before: dict = {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.compute(key)
        self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
