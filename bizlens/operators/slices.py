"""Period slices that several outputs of one request share, forgotten when their table changes."""

from __future__ import annotations

import datetime as dt
from collections import OrderedDict
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from bizlens.operators.reports import period_slice


class Slices:
    """Slices by table name and period, persisted (memory, spilling to disk) the first time an output reads them.

    A slice belongs to a version of its table (for snapshots: ``snapshots.version``). Asked for with another version it is
    freed and built anew; :meth:`clear` frees all, or those of one table. At most ``most`` are held: the one
    unused for longest goes first.
    """

    def __init__(self, most: int = 8):
        self.most = most
        self._held: OrderedDict[tuple, tuple[object, DataFrame]] = OrderedDict()

    def get(self, name: str, version: object, table: Callable[[], DataFrame], start: dt.date, end: dt.date,
            date_col: str = "data") -> DataFrame:
        key = (name, date_col, start, end)
        if key in self._held:
            held, df = self._held[key]
            if held == version:
                self._held.move_to_end(key)
                return df
            self._drop(key)
        df = period_slice(table(), date_col, start, end).persist(StorageLevel.MEMORY_AND_DISK)
        self._held[key] = (version, df)
        while len(self._held) > self.most:
            self._drop(next(iter(self._held)))
        return df

    def clear(self, name: str | None = None) -> int:
        """Frees all slices, or those of one table; returns how many."""
        keys = [k for k in self._held if name in (None, k[0])]
        for key in keys:
            self._drop(key)
        return len(keys)

    def _drop(self, key: tuple) -> None:
        self._held.pop(key)[1].unpersist()
