"""Phrases of two to five words that occur more often than their parts suggest.

A phrase of m + 1 words is a pair of two overlapping phrases of m words, at neighbouring
places. So one counting step serves all lengths: words, and then the frequent phrases of each
length, are ranked by frequency, a text becomes the sequence of its ranks, and neighbouring
ranks are counted as pairs. A pair lies in the tile given by the high bits of both ranks. A
chunk of texts counts tiles with many pairs by direct address, in a dense array; the pairs of
all other tiles are sorted (coordinate lists). Counts of chunks meet in an aggregation by
pair; frequent pairs are ranked again and are the ids of the next length. A phrase can only
be frequent if both its halves are, so nothing is lost on the way.

Of each length the ``HANDED`` most frequent phrases and their ranks are handed to the tasks as
a sorted table; ranks beyond it reach a chunk by a join on the pairs that occur in it. The
number decides where a rank is looked up, not which phrases are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm.textops import Texts, chunks

LONGEST, LEAST, TOP = 5, 100, 2000
#: Texts and chunks reach Python in batches of at most so many rows and bytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2097152",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}
#: Phrases of one length whose ranks are handed to tasks.
HANDED = 1_000_000
#: Distinct pairs that a task counts together before they are shuffled.
HELD = 500_000
#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 20
#: Ranks of one side of a tile, as a power of two; pairs that make a tile worth an array.
TILE_BITS = 10
DENSE = 1 << (2 * TILE_BITS - 4)

_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _STOP.copy()
_GAP[[9, 32]] = True


def _words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word, and whether a piece ends before it."""
    gap = _GAP[texts.data]
    edge = np.zeros(len(gap) + 1, bool)
    edge[texts.offsets] = True
    at = np.ones(len(gap) + 1, bool)
    at[1:-1] = gap[:-1] != gap[1:]
    change = at | edge
    starts = np.flatnonzero(~gap & change[:-1])
    ends = np.flatnonzero(~gap & change[1:]) + 1
    text = texts.text_of(starts)
    stops = np.zeros(len(gap) + 1, np.int64)
    np.cumsum(_STOP[texts.data], out=stops[1:])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (stops[starts[1:]] != stops[ends[:-1]]) | (text[1:] != text[:-1])
    return starts, ends, text, fresh


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ranges as strings; they ascend and do not overlap."""
    offsets = np.append(np.stack([starts, ends], 1).ravel(), len(data))
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    both = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)
    return both.take(pa.array(np.arange(0, 2 * len(starts), 2)))


_CHUNK = "chunk bigint, ids binary, words array<struct<lang:string,word:string,n:bigint>>"


def _encoded(batches):
    """One row for each chunk: its distinct words with counts, and its texts as their numbers,
    with -1 before each piece. Chunk ids are fixed once the rows are written."""
    task, nth = TaskContext.get().partitionId(), 0
    for batch in chunks(batches, "text", CHUNK):
        texts = Texts(batch.column("text"), lower=True)
        starts, ends, text, fresh = _words(texts)
        if not len(starts):
            continue
        words = _strings(texts.data, starts, ends).dictionary_encode()
        langs = batch.column("lang").fill_null("und").dictionary_encode()
        n_langs = len(langs.dictionary)
        code = words.indices.to_numpy().astype(np.int64) * n_langs
        code += langs.indices.to_numpy().astype(np.int64)[text]
        code, local, times = np.unique(code, return_inverse=True, return_counts=True)
        ids = np.full(len(local) + int(fresh.sum()), -1, np.int32)
        ids[np.arange(len(local)) + np.cumsum(fresh)] = local
        listed = pa.StructArray.from_arrays(
            [
                langs.dictionary.take(pa.array(code % n_langs)),
                words.dictionary.take(pa.array(code // n_langs)).cast(pa.string()),
                pa.array(times.astype(np.int64)),
            ],
            ["lang", "word", "n"],
        )
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([task << 32 | nth], pa.int64()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "words": pa.ListArray.from_arrays(pa.array([0, len(code)], pa.int32()), listed),
            }
        )
        nth += 1


def count_pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (first rank << 32 | second rank) of neighbours in ``ids``, and their counts;
    negative ranks pair with nothing."""
    ids = ids.astype(np.int64)
    both = (ids[:-1] >= 0) & (ids[1:] >= 0)
    a, b = ids[:-1][both], ids[1:][both]
    tile = (a >> TILE_BITS) << 32 | (b >> TILE_BITS)
    names, of, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    out = []
    low = (1 << TILE_BITS) - 1
    for k in np.flatnonzero(sizes >= DENSE):
        inside = of == k
        cell = (a[inside] & low) << TILE_BITS | (b[inside] & low)
        counts = np.bincount(cell, minlength=1 << 2 * TILE_BITS)
        cell = np.flatnonzero(counts)
        base = (names[k] >> 32 << TILE_BITS) << 32 | (names[k] & 0xFFFFFFFF) << TILE_BITS
        out.append((base + ((cell >> TILE_BITS) << 32 | (cell & low)), counts[cell]))
    sparse = sizes[of] < DENSE
    out.append(np.unique(a[sparse] << 32 | b[sparse], return_counts=True))
    return np.concatenate([c for c, _ in out]), np.concatenate([n for _, n in out])


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several lists of codes in one list."""
    codes = np.concatenate([c for c, _ in held])
    times = np.concatenate([n for _, n in held])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(times[order], first)


def _sequences(batches):
    """(chunk, ranks) of each row."""
    for batch in batches:
        for chunk, ids in zip(batch.column("chunk").to_pylist(), batch.column("ids"), strict=True):
            yield chunk, np.frombuffer(ids.as_buffer(), np.int32).astype(np.int64)


def _pairs(batches):
    """(code, n) of the pairs of a task's chunks, summed while they fit in ``HELD``."""

    def rows(codes, times):
        for a in range(0, len(codes), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_pydict(
                {"code": codes[part], "n": times[part].astype(np.int64)}
            )

    held, size = [], 0
    for _, ids in _sequences(batches):
        held.append(count_pairs(ids))
        size += len(held[-1][0])
        if size > HELD and len(held) > 1:
            held = [_added(held)]
            size = len(held[0][0])
        if size > HELD:
            yield from rows(*_added(held))
            held, size = [], 0
    if size:
        yield from rows(*_added(held))


def _codes(ids: np.ndarray) -> np.ndarray:
    """The pair code at each place of a sequence, -1 where there is none."""
    out = np.full(len(ids), -1, np.int64)
    both = (ids[:-1] >= 0) & (ids[1:] >= 0)
    out[:-1][both] = ids[:-1][both] << 32 | ids[1:][both]
    return out


def _looked_up(codes: np.ndarray, known: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rank of each code in a sorted list of known codes, -1 where it is not known."""
    if not len(known):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, ranks[at], -1)


def _squeezed(chunk: int, ids: np.ndarray) -> dict:
    """A chunk's sequence with runs of negative ranks shortened to one; no row if that is all."""
    keep = ids >= 0
    keep[1:] |= ids[:-1] >= 0
    some = bool((ids >= 0).any())
    return {
        "chunk": pa.array([chunk] * some, pa.int64()),
        "ids": pa.array([ids[keep].astype(np.int32).tobytes()] * some, pa.binary()),
    }


def _sorted(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    code, rank = (rows.column(c).to_numpy() for c in ("code", "id"))
    order = np.argsort(code)
    return code[order], rank[order]


def _in_ranks(sequences: DataFrame, longer: DataFrame, handed: int) -> DataFrame:
    """``sequences`` (chunk, ids) in the ranks of ``longer`` (code, id), written."""
    spark = sequences.sparkSession
    table = longer.where(F.col("id") < handed).select("code", "id").toArrow()
    shared = spark.sparkContext.broadcast(_sorted(table))

    def run(batches):
        for chunk, ids in _sequences(batches):
            ranks = _looked_up(_codes(ids), *shared.value)
            yield pa.RecordBatch.from_pydict(_squeezed(chunk, ranks))

    def distinct(batches):
        for chunk, ids in _sequences(batches):
            codes = np.unique(_codes(ids))
            yield pa.RecordBatch.from_pydict({"of": np.full(len(codes), chunk), "code": codes})

    def both(key, sequence: pa.Table, rest: pa.Table) -> pa.Table:
        for chunk, ids in _sequences(sequence.to_batches()):
            codes = _codes(ids)
            ranks = _looked_up(codes, *shared.value)
            return pa.table(_squeezed(chunk, np.maximum(ranks, _looked_up(codes, *_sorted(rest)))))
        return pa.table(_squeezed(0, np.full(1, -1)))

    rest = longer.where(F.col("id") >= handed).select("code", "id")
    if rest.isEmpty():
        renamed = sequences.mapInArrow(run, "chunk bigint, ids binary")
    else:
        found = sequences.mapInArrow(distinct, "of bigint, code bigint")
        found = found.join(rest.hint("merge"), "code").select("of", "code", "id")
        pairs = sequences.groupBy("chunk").cogroup(found.groupBy("of"))
        renamed = pairs.applyInArrow(both, "chunk bigint, ids binary")
    renamed = runtime.written(renamed, "phrase-sequences")
    shared.destroy()
    return renamed


def _words_in_ranks(coded: DataFrame, words: DataFrame, handed: int) -> DataFrame:
    """The chunks of ``_encoded`` as sequences (chunk, ids) of the ranks of ``words``, written."""
    spark = coded.sparkSession
    table = words.where(F.col("id") < handed).select("lang", "phrase", "id").toArrow()
    # a word holds no tab, so the pair can be told from the joined text
    names = pc.binary_join_element_wise(table.column("lang"), table.column("phrase"), "\t")
    names = names.combine_chunks().cast(pa.large_string())
    shared = spark.sparkContext.broadcast((names, table.column("id").to_numpy()))

    def sequence(chunk, ids: bytes, listed: pa.Array, codes=None, ranks=None) -> dict:
        names, known = shared.value
        own = pc.binary_join_element_wise(listed.field("lang"), listed.field("word"), "\t")
        at = pc.index_in(own.cast(pa.large_string()), value_set=names).fill_null(-1).to_numpy()
        of = np.where(at >= 0, known[at] if len(known) else -1, -1)
        if codes is not None:
            of[codes] = ranks
        local = np.frombuffer(ids, np.int32)
        return _squeezed(chunk, np.where(local >= 0, of[local], -1))

    def run(batches):
        for batch in batches:
            for k, chunk in enumerate(batch.column("chunk").to_pylist()):
                ids, words = batch.column("ids")[k].as_py(), batch.column("words")[k].values
                yield pa.RecordBatch.from_pydict(sequence(chunk, ids, words))

    def both(key, chunk: pa.Table, rest: pa.Table) -> pa.Table:
        for batch in chunk.to_batches():
            ids, words = batch.column("ids")[0].as_py(), batch.column("words")[0].values
            return pa.table(sequence(key[0].as_py(), ids, words, *_sorted(rest)))
        return pa.table(_squeezed(0, np.full(1, -1)))

    rest = words.where(F.col("id") >= handed).select("lang", "phrase", "id")
    if rest.isEmpty():
        ranked_ = coded.mapInArrow(run, "chunk bigint, ids binary")
    else:
        listed = coded.select(F.col("chunk").alias("of"), F.posexplode("words").alias("code", "w"))
        listed = listed.select(
            "of", F.col("code").cast("bigint").alias("code"), "w.lang", F.col("w.word").alias("phrase")
        )
        found = listed.join(rest.hint("merge"), ["lang", "phrase"]).select("of", "code", "id")
        pairs = coded.groupBy("chunk").cogroup(found.groupBy("of"))
        ranked_ = pairs.applyInArrow(both, "chunk bigint, ids binary")
    ranked_ = runtime.written(ranked_, "phrase-sequences")
    shared.destroy()
    return ranked_


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``id``, their place from 0 in ``order``, which must be total; written.

    Rows are dealt by ranges of the order and numbered within each; only the number of rows
    of each range passes through one task.
    """
    dealt = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    dealt = runtime.written(dealt, "phrase-ranks")
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part")) - F.col("__n")
    sizes = sizes.select("__part", before.alias("__before"))
    nth = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    out = dealt.withColumn("__nth", nth).join(sizes, "__part")
    out = out.withColumn("id", F.col("__nth") + F.col("__before"))
    out = runtime.written(out.drop("__part", "__nth", "__before"), "phrase-ranks")
    runtime.released(dealt)
    return out


def _frequent_words(coded: DataFrame, least: int) -> DataFrame:
    """Phrases of one word: id, lang, phrase, last (word), f, heads and tails (counts of the
    phrase's first and last 1, 2, ... words)."""
    counts = coded.select(F.inline("words")).groupBy("lang", "word").agg(F.sum("n").alias("f"))
    own = F.array("f")
    return ranked(
        counts.where(F.col("f") >= least).select(
            "lang",
            F.col("word").alias("phrase"),
            F.col("word").alias("last"),
            "f",
            own.alias("heads"),
            own.alias("tails"),
        ),
        F.desc("f"),
        F.col("lang"),
        F.col("phrase"),
    )


def _frequent_pairs(counts: DataFrame, parts: DataFrame, least: int) -> DataFrame:
    """The next longer phrases, from counts of pairs of ``parts``; columns as there, and code,
    left and right (ids of the parts)."""
    pairs = (
        counts.groupBy("code")
        .agg(F.sum("n").alias("f"))
        .where(F.col("f") >= least)
        .withColumn("left", F.shiftright("code", 32))
        .withColumn("right", F.col("code").bitwiseAND((1 << 32) - 1))
    )
    left = parts.select(F.col("id").alias("left"), "lang", "phrase", "heads")
    right = parts.select(F.col("id").alias("right"), "last", "tails")
    more = F.array(F.col("f"))
    return ranked(
        pairs.join(left, "left")
        .join(right, "right")
        .select(
            "code", "left", "right", "lang",
            F.concat_ws(" ", "phrase", "last").alias("phrase"),
            "last", "f",
            F.concat("heads", more).alias("heads"),
            F.concat("tails", more).alias("tails"),
        ),
        F.desc("f"),
        F.col("code"),
    )


def _not_inside(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    """Phrases that no phrase of one more word holds as often. A phrase longer still that does
    so has one between that does, and is frequent."""
    parts = longer.select(
        F.explode(F.array(F.struct(F.col("left").alias("id"), "f"),
                          F.struct(F.col("right").alias("id"), "f"))).alias("part")
    ).select("part.id", F.col("part.f").alias("__f"))
    most = parts.groupBy("id").agg(F.max("__f").alias("__f"))
    kept = phrases.join(most, "id", "left")
    return kept.where(F.col("__f").isNull() | (F.col("__f") < F.col("f"))).drop("__f")


def _scored(phrases: DataFrame, words: int) -> DataFrame:
    """With l, r and score of the lowest-scoring cut; ties go to the earliest."""
    cuts = []
    for k in range(1, words):
        cut = f"heads[{k - 1}]", f"tails[{words - k - 1}]"
        score = (
            "(cast(f AS decimal(19,0)) * cast(1000 AS decimal(4,0)) * cast(n AS decimal(15,0)))"
            f" div (cast({cut[0]} AS decimal(19,0)) * cast({cut[1]} AS decimal(18,0)))"
        )
        cuts.append(F.expr(f"named_struct('score', {score}, 'k', {k}, 'l', {cut[0]}, 'r', {cut[1]})"))
    best = F.array_min(F.array(*cuts))
    return phrases.withColumn("__cut", best).select(
        "lang", "phrase", F.col("f").alias("a"), "__cut.l", "__cut.r", "n", "__cut.score"
    )


def phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    handed: int = HANDED,
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): every phrase of two to ``longest`` words that occurs
    at least ``least`` times, unless a longer one holds it as often.

    A-Z are lower-cased; texts fall into pieces at ``.,;:!?`` and the controls 10 to 13, and
    these into words at blanks and tabs; a phrase lies within a piece. ``n`` counts the words
    of the language, ``a`` all places of the phrase. Of the cuts of a phrase in two, with
    counts l and r, the lowest floor(1000 a n / (l r)) is its score.

    A null text is empty, a null language is ``und``. Repeated rows count each; an empty table
    gives no rows. Other columns are not read. Long texts are read whole, in one chunk each.
    """
    with runtime.settings(docs.sparkSession, **BATCHES):
        return _phrases(docs, text, lang, least, longest, handed)


def _phrases(
    docs: DataFrame, text: str, lang: str, least: int, longest: int, handed: int
) -> DataFrame:
    docs = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    coded = runtime.written(docs.mapInArrow(_encoded, _CHUNK), "phrase-chunks")
    totals = coded.select(F.inline("words")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = runtime.written(totals, "phrase-totals")
    parts = _frequent_words(coded, least)
    sequences = _words_in_ranks(coded, parts, handed)
    runtime.released(coded)
    found, before = [], None
    for words in range(2, longest + 1):
        counts = sequences.mapInArrow(_pairs, "code bigint, n bigint")
        longer = _frequent_pairs(counts, parts, least)
        if words < longest:
            shorter, sequences = sequences, _in_ranks(sequences, longer, handed)
            runtime.released(shorter)
        if before is not None:
            found.append((_not_inside(before, longer), words - 1))
        parts = before = longer
    found.append((before, longest))
    scored = [_scored(p.join(totals, "lang"), m) for p, m in found]
    out = scored[0]
    for more in scored[1:]:
        out = out.unionByName(more)
    return out


def top_phrases(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """``phrases`` with ``rank``: the ``top`` of each language by falling score, then count,
    then the phrase's bytes."""
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    numbered = phrases(docs, **options).withColumn("rank", F.row_number().over(order))
    return numbered.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
