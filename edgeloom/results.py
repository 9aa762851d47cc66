"""Remembered results: tables by the fingerprint of what they were made from."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Hashable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame

from .operators.edges import fingerprint


class Memo:
    """The `size` last results, persisted; the one unused for longest is unpersisted first."""

    def __init__(self, size: int = 64):
        self.size, self.held = size, OrderedDict()

    def of(self, edges: DataFrame, make: Callable[[DataFrame], DataFrame], *config: Hashable) -> DataFrame:
        """make(edges), once for each set of edges, whatever their order, and config."""
        key = (fingerprint(edges), make, config)
        if key in self.held:
            self.held.move_to_end(key)
            return self.held[key]
        out = self.held[key] = make(edges).persist()
        while len(self.held) > self.size:
            self.held.popitem(last=False)[1].unpersist()
        return out

    def clear(self) -> None:
        while self.held:
            self.held.popitem()[1].unpersist()


_pool: ThreadPoolExecutor | None = None


def in_background(action: Callable, *args) -> Future:
    """An action (a count, a write) beside others; Spark runs the jobs of threads together."""
    global _pool
    _pool = _pool or ThreadPoolExecutor(4, "edgeloom")
    return _pool.submit(action, *args)
