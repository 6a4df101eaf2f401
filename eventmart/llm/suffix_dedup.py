"""Passages that repeat across texts, by a sparse suffix array.

A passage repeats if all its windows of ``MIN_WORDS`` words do. Each window belongs to its
minimiser: the place in it whose next ``SEED`` words hash lowest among its first ``GAP``
places. Only the suffixes that begin at these places are kept. Equal windows have equal
minimisers at equal distances, so places whose seed occurs once are dropped after one count
with partial aggregates, and the suffixes of the others meet under their seed, with the words
around it that their windows reach.

There they are sorted by the words to the right, and neighbours compared: the words that two
neighbours have in common extend the match to the right, and the least of several such
numbers holds for suffixes further apart. A window that begins ``l`` words before the seed
lies in a run of neighbours with at least ``MIN_WORDS - l`` words in common; there the match
is extended to the left, and windows with the same ``l`` words are repeats. A text's marked
windows merge to spans.

A seed that very many texts share is dealt to several tasks by salts. Each of them marks
what occurs twice in it and passes on every distinct window once; in a second round equal
windows of all salts meet, one row for each salt at most, and a window that was alone in its
salt is marked if another salt has it too. So the result does not depend on the salts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm.textops import Texts, chain, hash_ranges, mix, per_chunk

MIN_WORDS = 50
SEED = 12
#: Most words of a window on either side of its seed, and the places among which that lies.
SIDE = MIN_WORDS - SEED
GAP = SIDE + 1
#: Bytes of a word's hash that a suffix carries for each word.
CODE = 5
#: Places of one seed that one task compares.
DEALT = 1_024


def minimisers(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``MIN_WORDS`` words inside a text, and the minimiser of
    each: of its first ``GAP`` seeds the place of the least. Both ascend.

    Of equal hashes the last one counts. A text with fewer than ``MIN_WORDS`` words has none.
    """
    n = len(hashes) - MIN_WORDS + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2
    seeds = chain(hashes, SEED)[: n + GAP - 1]
    window = np.lib.stride_tricks.sliding_window_view(seeds[::-1], GAP)
    chosen = np.empty(n, np.int64)
    for a in range(0, n, 1 << 16):
        part = window[::-1][a : a + (1 << 16)]
        chosen[a : a + len(part)] = np.arange(a, a + len(part)) + GAP - 1 - part.argmin(axis=1)
    whole = np.flatnonzero(text[:n] == text[MIN_WORDS - 1 :])
    return whole, chosen[whole]


def _words(batch: pa.RecordBatch):
    texts = Texts(batch.column("text"))
    starts, ends, text = texts.words()
    hashes = hash_ranges(texts.data, starts, ends)
    return texts, starts, ends, text, hashes


def _seeds(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(seed, n): places of each seed, summed over the batch."""
    _, _, _, text, hashes = _words(batch)
    at = np.unique(minimisers(hashes, text)[1])
    seeds, n = np.unique(chain(hashes, SEED)[at] if len(at) else np.empty(0, np.uint64),
                         return_counts=True)
    return pa.RecordBatch.from_pydict({"seed": seeds.view(np.int64), "n": n.astype(np.int64)})


def _places(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(seed, doc, at): every minimiser of every text, and its word position."""
    _, _, _, text, hashes = _words(batch)
    at = np.unique(minimisers(hashes, text)[1])
    first = np.searchsorted(text, text[at], "left")
    seeds = chain(hashes, SEED)[at] if len(at) else np.empty(0, np.uint64)
    docs = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "seed": seeds.view(np.int64),
            "doc": docs[text[at]] if len(at) else np.empty(0, np.int64),
            "at": (at - first).astype(np.int32),
        }
    )


def _suffixes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each repeated place (at) with its windows, which start from ``far`` to ``near`` words
    before it, and the codes of the words that these reach, but for the seed's."""
    _, _, _, text, hashes = _words(batch)
    first = np.searchsorted(text, np.arange(batch.num_rows), "left")
    held = batch.column("places")
    places = held.flatten()
    seed, at, salt, dealt = (
        places.field(c).to_numpy(zero_copy_only=False) for c in ("seed", "at", "salt", "dealt")
    )
    owner = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
    of = np.full(len(hashes) + 1, -1, np.int64)
    of[first[owner] + at] = np.arange(len(at))
    begin, chosen = minimisers(hashes, text)
    row = of[chosen]
    begin, row = begin[row >= 0], row[row >= 0]
    # the windows of a place start at successive words
    new = np.flatnonzero(np.diff(row, prepend=-1))
    last = np.append(new[1:], len(row)) - 1
    row, word = row[new], first[owner[row[new]]] + at[row[new]]
    far, near = word - begin[new], word - begin[last[: len(new)]]
    left, right = far, SIDE - near
    size = left + right
    ends = np.cumsum(size)
    nth = np.arange(int(size.sum())) - np.repeat(ends - size, size)
    place = np.repeat(word - far, size) + nth + np.where(nth >= np.repeat(left, size), SEED, 0)
    codes = hashes[place].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()
    offsets = np.append(0, ends * CODE).astype(np.int32)
    docs = batch.column("doc").to_numpy(zero_copy_only=False)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(codes)]
    return pa.RecordBatch.from_pydict(
        {
            "seed": seed[row],
            "salt": salt[row],
            "dealt": dealt[row],
            "doc": docs[owner[row]],
            "at": at[row].astype(np.int32),
            "far": far.astype(np.int8),
            "near": near.astype(np.int8),
            "codes": pa.Array.from_buffers(pa.binary(), len(row), buffers),
        }
    )


def _groups(batches):
    """The same rows, in batches that hold all rows of a seed and salt, and for each row the
    number of its group; rows come sorted by seed and salt."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        group = _numbered(batch)
        cut = int(np.searchsorted(group, group[-1], "left"))
        held = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut), group[:cut]
    if held is not None:
        yield held, np.zeros(held.num_rows, np.int64)


def _numbered(batch: pa.RecordBatch) -> np.ndarray:
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "salt")]
    return np.cumsum(np.any([np.diff(k, prepend=k[0]) != 0 for k in keys], axis=0))


def _sides(codes: pa.Array, far: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word codes to the left of each seed, nearest first, and to the right; 0 beyond."""
    flat = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, CODE)
    wide = np.zeros((len(flat), 8), np.uint8)
    wide[:, 8 - CODE :] = flat
    words = wide.view(">u8")[:, 0].astype(np.uint64)
    size = far + SIDE - near
    row = np.repeat(np.arange(len(far)), size)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    before = nth < far[row]
    left, right = np.zeros((2, len(far), SIDE), np.uint64)
    left[row[before], far[row[before]] - 1 - nth[before]] = words[before]
    right[row[~before], nth[~before] - far[row[~before]]] = words[~before]
    return left, right


def _suffix_order(group: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rows sorted by group and then by the words of the suffix."""
    key = np.concatenate([group[:, None].astype(np.uint64), right], axis=1).astype(">u8")
    parts = key.view(np.uint8).reshape(len(group), -1, 8)[:, :, 8 - CODE :]
    whole = np.ascontiguousarray(parts).reshape(len(group), -1)
    return np.argsort(whole.view(f"S{whole.shape[1]}")[:, 0], kind="stable")


def _folded(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, 2, ... columns of each row."""
    out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
    for k in range(words.shape[1]):
        out[:, k + 1] = mix(out[:, k] * np.uint64(0xD6E8FEB86659FD93) + words[:, k] + np.uint64(1))
    return out


def _repeats(batches):
    """Spans (doc, lo, hi) of words, of the windows that occur twice in their group; and of
    dealt seeds each distinct window of the group, with its hash and whether it is alone."""
    for batch, group in _groups(batches):
        seed, doc, at, far, near, dealt = (
            batch.column(c).to_numpy(zero_copy_only=False)
            for c in ("seed", "doc", "at", "far", "near", "dealt")
        )
        far, near = far.astype(np.int64), near.astype(np.int64)
        left, right = _sides(batch.column("codes"), far, near)
        order = _suffix_order(group, right)
        group, seed, doc, at, far, near, dealt = (
            c[order] for c in (group, seed, doc, at, far, near, dealt)
        )
        left, right = left[order], right[order]
        # words that a suffix has in common with the one before it
        same = right[1:] == right[:-1]
        common = np.where(same.all(axis=1), SIDE, same.argmin(axis=1))
        common = np.minimum(common, SIDE - np.maximum(near[1:], near[:-1]))
        common[group[1:] != group[:-1]] = -1
        before = _folded(left)
        after = _folded(right) if dealt.any() else None
        twice = np.zeros((len(order), SIDE + 1), bool)
        ones = []
        for reach in range(SIDE + 1):
            rows = np.flatnonzero((near <= reach) & (reach <= far))
            if not len(rows):
                continue
            run = np.append(0, np.cumsum(common < SIDE - reach))[rows]
            match = mix(before[rows, reach] + run.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            rank = np.argsort(match, kind="stable")
            new = np.ones(len(rank), bool)
            new[1:] = match[rank][1:] != match[rank][:-1]
            times = np.diff(np.append(np.flatnonzero(new), len(rank)))
            twice[rows[rank], reach] = np.repeat(times > 1, times)
            firsts = rows[rank[new]]
            firsts = firsts[dealt[firsts]]
            if len(firsts):
                whole = mix(before[firsts, reach] ^ seed[firsts].view(np.uint64))
                whole = mix(whole + after[firsts, SIDE - reach] + np.uint64(reach))
                ones.append((firsts, np.full(len(firsts), reach), whole, ~twice[firsts, reach]))
        # windows in order of their first words, with a gap behind each row
        marks = np.zeros((len(order), SIDE + 2), bool)
        marks[:, :-1] = twice[:, ::-1]
        edge = np.flatnonzero(np.diff(marks.ravel(), prepend=False))
        row, start = edge[::2] // (SIDE + 2), SIDE - edge[::2] % (SIDE + 2)
        stop = SIDE - edge[1::2] % (SIDE + 2)
        one, reach, window, alone = (
            (np.concatenate(c) for c in zip(*ones, strict=True)) if ones
            else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))
        )
        none = np.zeros(len(row), bool)
        yield pa.RecordBatch.from_pydict(
            {
                "doc": np.append(doc[row], doc[one]),
                "lo": np.append(at[row] - start, at[one] - reach).astype(np.int32),
                "hi": (np.append(at[row] - stop - 1, at[one] - reach) + MIN_WORDS).astype(np.int32),
                "window": pa.array(
                    np.append(np.zeros(len(row), np.int64), window.view(np.int64)),
                    mask=np.append(~none, np.zeros(len(one), bool)),
                ),
                "alone": np.append(none, alone),
            }
        )


def _merged(spans) -> list[tuple[int, int]]:
    """Unions of overlapping or touching (lo, hi)."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))
_TYPE = "array<struct<start:bigint,end:bigint,words:bigint>>"


def _placed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Merged spans of each text in code points."""
    texts = Texts(batch.column("text"))
    starts, ends, text = texts.words()
    first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=texts.n))])
    points = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
    out = []
    for k, found in enumerate(batch.column("found").to_pylist()):
        base = points[texts.offsets[k]]
        out.append(
            [
                {
                    "start": int(points[starts[first[k] + lo]] - base),
                    "end": int(points[ends[first[k] + hi - 1]] - base),
                    "words": hi - lo,
                }
                for lo, hi in _merged((s["lo"], s["hi"]) for s in found or ())
            ]
        )
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "spans": pa.array(out, _SPANS)})


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row (doc_id, spans) for each row of ``docs``; ``spans`` is an array of (start, end,
    words) in code points, end exclusive, of passages of at least 50 words that stand
    elsewhere too, in another text or at another place of the same one.

    A null, empty or short text has no spans. Rows with equal doc_id and text are one
    document: they get the same spans, and are no repeat of each other. A row with a null
    doc_id is a document like others. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # 64 bits name a document by its id and text
    doc = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    keyed = docs.withColumn("doc", doc)
    counted = docs.select("text").mapInArrow(per_chunk(_seeds, "text"), "seed bigint, n bigint")
    seeds = runtime.written(
        counted.groupBy("seed")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("seed", F.ceil(F.col("n") / F.lit(DEALT)).cast("int").alias("k")),
        "suffix-seeds",
    )
    places = keyed.select("doc", "text").mapInArrow(
        per_chunk(_places, "text"), "seed bigint, doc bigint, at int"
    )
    salt = F.pmod(F.xxhash64("doc", "at"), F.col("k")).cast("int")
    dealt = F.col("k") > 1
    held = (
        places.join(seeds, "seed")
        .select("doc", F.struct("at", "seed", salt.alias("salt"), dealt.alias("dealt")).alias("place"))
        .groupBy("doc")
        .agg(F.collect_set("place").alias("places"))
    )
    held = runtime.written(held, "suffix-places")
    marked = (
        keyed.join(held, "doc")
        .select("doc", "text", "places")
        .dropDuplicates(["doc"])
        .mapInArrow(
            per_chunk(_suffixes, "text"),
            "seed bigint, salt int, dealt boolean, doc bigint, at int, far tinyint, near tinyint,"
            " codes binary",
        )
        .repartition("seed", "salt")
        .sortWithinPartitions("seed", "salt")
        .mapInArrow(_repeats, "doc bigint, lo int, hi int, window bigint, alone boolean")
    )
    marked = runtime.written(marked, "suffix-windows")
    runtime.released(held, seeds)
    span = F.struct("doc", "lo", "hi")
    across = (
        marked.where("window is not null")
        .groupBy("window")
        .agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("alone"), span)).alias("spans"))
        .where("n > 1")
        .select(F.explode("spans").alias("span"))
        .select("span.*")
    )
    spans = (
        marked.where("window is null")
        .select("doc", "lo", "hi")
        .unionByName(across)
        .groupBy("doc")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("found"))
    )
    spans = runtime.written(spans, "suffix-spans")
    runtime.released(marked)
    return (
        keyed.join(spans, "doc", "left")
        .select("doc_id", "text", "found")
        .mapInArrow(per_chunk(_placed, "text"), f"doc_id bigint, spans {_TYPE}")
    )
