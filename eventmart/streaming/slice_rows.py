"""The state processor behind ``sessions``.

Kept free of other package modules: it is pickled by value, so executors run it without the
package being installed on them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUT_NAMES = (
    "slice", "is_first", "is_last", "place", "at_us", "state", "next_us", "next_state",
)
OUT_TYPES = "bigint, boolean, boolean, bigint, bigint, string, bigint, string".split(", ")


class SliceRows(StatefulProcessor):
    """Holds the rows of one slice and bucket; emits each key's neighbours at its end.

    A held row is (key, state, order...).
    """

    def __init__(self, held: T.StructType, slice_ms: int, start: str, end: str):
        self.held = held
        self.out = Row(held.fieldNames()[0], *OUT_NAMES)
        self.slice_ms = slice_ms
        self.start = start
        self.end = end

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.held)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.held.fieldNames()
        self.rows.appendList([tuple(r[n] for n in names) for r in rows])
        self.handle.registerTimer((key[0] + 1) * self.slice_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [tuple(r) for r in self.rows.get()]
        self.rows.clear()
        held.sort(key=lambda r: (r[0] is None, r[0], r[2:]))
        place = 0
        for i, row in enumerate(held):
            first = i == 0 or held[i - 1][0] != row[0]
            last = i + 1 == len(held) or held[i + 1][0] != row[0]
            place = 0 if first else place + 1
            state, at, then, next_at = row[1], row[2], None, None
            if not last:
                then, next_at = held[i + 1][1], held[i + 1][2]
            if first or last or (state == self.start and then == self.end):
                yield self.out(row[0], key[0], first, last, place, at, state, next_at, then)
