"""Words, lines and hashes of whole Arrow batches in numpy.

A column of texts is one byte array plus offsets; words and lines are index ranges in it.
Nothing here loops over characters or words in Python. Hashes have 64 bits: a polynomial
over randomised bytes, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled alone.
CHUNK = 2 << 20
#: Bytes hashed at once within a text.
SEGMENT = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (shift, multiply) of each element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Scratch(dict):
    """Tables of this process that do not travel with task functions."""

    def __reduce__(self):
        return Scratch, ()


_TABLES = Scratch()


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    return _TABLES["up"], _TABLES["down"]


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range; ranges are ascending and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _tables(max(hi - lo + 1, SEGMENT // 8))
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s]
        out[i:j] += (e - s).astype(np.uint64)
        i = j
    return mix(out)


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbours; runs may cross documents, mask them after."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    m = len(hashes) - n + 1
    out = hashes[:m] + np.uint64(n)
    for k in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + m])
    return out


class Texts:
    """Texts of one batch. Null counts as empty."""

    def __init__(self, column: pa.Array, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pa.concat_arrays([column.cast(pa.large_string()).fill_null("")])
        n = len(column)
        buffers = column.buffers()
        if n == 0 or buffers[2] is None:
            self.offsets, self.data = np.zeros(n + 1, np.int64), np.empty(0, np.uint8)
        else:
            o = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
            self.data = np.frombuffer(buffers[2], np.uint8)[o[0] : o[-1]]
            self.offsets = o - o[0]
        if lower:
            self.data = LOWER[self.data]
        self.n = n

    def _breaks(self) -> tuple[np.ndarray, np.ndarray]:
        space = SPACE[self.data]
        before = np.empty(len(space), bool)
        before[:1], before[1:] = True, space[:-1]
        firsts = self.offsets[:-1]
        before[firsts[firsts < len(space)]] = True
        return space, before

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each run of bytes other than white space."""
        if not len(self.data):
            return (np.empty(0, np.int64),) * 3
        space, before = self._breaks()
        after = np.empty(len(space), bool)
        after[-1:], after[:-1] = True, before[1:] | space[1:]
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        return starts, ends, self.text_of(starts)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (without the line feed) and text number; each text has at least one."""
        feeds = np.flatnonzero(self.data == 10)
        owner = self.text_of(feeds) if len(feeds) else np.empty(0, np.int64)
        counts = np.bincount(owner, minlength=self.n) + 1 if self.n else np.empty(0, np.int64)
        text = np.repeat(np.arange(self.n), counts)
        at = np.cumsum(counts) - 1
        ends = np.empty(len(text), np.int64)
        last = np.zeros(len(text), bool)
        last[at] = True
        ends[last], ends[~last] = self.offsets[1:], feeds
        starts = np.empty(len(text), np.int64)
        first = np.zeros(len(text), bool)
        first[at[:-1] + 1], first[:1] = True, True
        starts[first], starts[~first] = self.offsets[:-1], feeds + 1
        return starts, ends, text

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def shingles(texts: Texts, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    starts, ends, text = texts.words()
    hashes = hash_ranges(texts.data, starts, ends)
    counts = np.bincount(text, minlength=texts.n)
    first = np.zeros(texts.n + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    runs = chain(hashes, n)
    out = []
    for k in range(texts.n):
        a, b = int(first[k]), int(first[k + 1])
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            out.append(chain(hashes[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text."""
    for batch in batches:
        ends = Texts(batch.column(text)).offsets[1:]
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def per_chunk(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch], text: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that applies ``fn`` to chunks of bounded text size."""

    def run(batches):
        for batch in chunks(batches, text):
            yield fn(batch)

    return run
