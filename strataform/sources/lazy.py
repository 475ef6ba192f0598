"""Tables that are built when they are first asked for."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from ..session import outside_scopes


def once(build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    """``build`` run at most once, whatever thread asks first."""
    lock, held = threading.RLock(), []

    def get() -> DataFrame:
        with lock:
            if not held:
                with outside_scopes():  # kept, whoever asks first
                    held.append(build())
            return held[0]
    return get


class LazyTables(Mapping):
    """Table name -> DataFrame; iterating over the names builds nothing."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._get = {name: once(build) for name, build in builders.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._get[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._get)

    def __len__(self) -> int:
        return len(self._get)
