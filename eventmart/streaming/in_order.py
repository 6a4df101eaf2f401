"""State processors that see the rows of a key in order.

Kept free of other package modules: they are pickled by value, so executors run them without
the package being installed on them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class InOrder(StatefulProcessor):
    """Holds the rows of a key until the watermark has passed them, then steps through them.

    A held row is (microseconds, further order columns..., payload columns...). Between steps
    one value is kept for each key; a timer of the key wakes it when its first row is due.
    """

    def __init__(self, held: T.StructType, ordered: int, kept: T.StructType, out: list[str]):
        self.held = held
        self.ordered = ordered
        self.kept_schema = kept
        self.out = Row(*out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.held)
        self.kept = handle.getValueState("kept", self.kept_schema)

    def _wake(self, rows: list[tuple]) -> None:
        self.handle.registerTimer(min(r[0] for r in rows) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.held.fieldNames()
        new = [tuple(r[n] for n in names) for r in rows]
        self.waiting.appendList(new)
        self._wake(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, later = [], []
        for row in self.waiting.get():
            (due if row[0] < passed else later).append(tuple(row))
        if not due:
            return
        due.sort(key=lambda r: [(v is not None, v) for v in r[: self.ordered]])
        kept = before = self.kept.get()
        for row in due:
            kept, found = self.step(kept, row)
            yield from (self.out(*key, *values) for values in found)
        if kept is not before:
            self.kept.update(kept)
        if later:
            self.waiting.put(later)
            self._wake(later)
        else:
            self.waiting.clear()

    def step(self, kept: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
        """The value to keep after ``row``, and output values that follow the key."""
        raise NotImplementedError


class SessionSteps(InOrder):
    """Keeps the last row (microseconds, state); a start and an end next to it are a session."""

    def __init__(self, held: T.StructType, out: list[str], start: str, end: str):
        kept = T.StructType().add("at_us", T.LongType()).add("state", T.StringType())
        super().__init__(held, len(held) - 1, kept, out)
        self.start, self.end = start, end

    def step(self, kept, row):
        pairs = kept is not None and kept[1] == self.start and row[-1] == self.end
        return (row[0], row[-1]), [(kept[0], row[0])] if pairs else []


class CrossingSteps(InOrder):
    """Keeps the side of a threshold; a row on another side than the one before is a crossing."""

    def __init__(self, held: T.StructType, out: list[str], threshold: float):
        kept = T.StructType().add("above", T.BooleanType())
        super().__init__(held, len(held) - 1, kept, out)
        self.threshold = threshold

    def step(self, kept, row):
        if row[-1] is None:
            return kept, []
        above = row[-1] >= self.threshold
        if kept is None:
            return (above,), [(row[0], row[-1], above)] if above else []
        if kept[0] == above:
            return kept, []
        return (above,), [(row[0], row[-1], above)]
