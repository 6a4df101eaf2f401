"""Document quality: base rules, then content and boilerplate lines by a sequence model.

A linear-chain conditional random field labels the lines of a text as content or
boilerplate; a text is kept when content holds at least half of its words.

The model learns from a bounded sample of whole labelled documents (``max_docs`` documents
of ``max_lines`` lines together); it then reads every line of every text. Document
labels become line labels in two rounds: first every line takes its document's label, then
lines of a rejected document that the first model calls content become content, unless they
would carry the document.

Rows: a null or empty text has no words and fails the base rules. Repeated rows, extra
columns and null ids pass through; each row is judged by its text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.llm import crf
from eventmart.llm.textops import SPACE, Texts, chain, hash_ranges, mix, per_chunk

CONTENT, BOILERPLATE = 0, 1
MIN_WORDS = 50
MIN_SHARE = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b"!?;:=_~^@/\\{}[]()\"'+-", np.uint8)] = True
_END = np.zeros(256, bool)
_END[np.frombuffer(b".!?", np.uint8)] = True

# Each feature group is a measure cut at these bounds.
_CUTS = {
    "words": [1, 2, 4, 8, 16, 32, 64],
    "symbols": [1e-9, 0.1, 0.3, 0.6, 1.0, 2.0],
    "upper": [0.02, 0.1, 0.3, 0.6, 0.9],
    "digits": [1e-9, 0.02, 0.1, 0.3],
    "marks": [1e-9, 0.05, 0.2, 0.5, 1.0],
    "length": [2.5, 3.5, 4.5, 5.5, 6.5, 8.0, 11.0],
    "repeats": [1e-9, 0.1, 0.3, 0.6, 0.9],
    "ended": [0.5],
    "again": [0.5],
    "edge": [0.5, 1.5],
}
N_FEATURES = sum(len(c) + 1 for c in _CUTS.values())


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def measure(texts: Texts) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts per text, features per line, line offsets per text, and words per line."""
    data, n = texts.data, texts.n
    ws, we, wt = texts.words()
    points = (data & 0xC0) != 0x80
    inked = points & ~SPACE[data]
    hashes = hash_ranges(data, ws, we)
    # words in windows of three that occur twice or more in the text
    repeated = np.zeros(len(ws), bool)
    if len(ws) >= 3:
        same = np.flatnonzero(wt[2:] == wt[:-2])
        key = chain(hashes, 3)[same] ^ mix(wt[same].astype(np.uint64) + np.uint64(1))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        hit = same[times[inverse] >= 2]
        for k in range(3):
            repeated[hit + k] = True
    ls, le, lt = texts.lines()
    first_word = np.searchsorted(ws, ls, "left")
    end_word = np.searchsorted(ws, le, "left")
    n_words = end_word - first_word
    key = hash_ranges(data, ls, le) ^ mix(lt.astype(np.uint64) + np.uint64(1))
    worded = np.flatnonzero(n_words > 0)
    _, firsts = np.unique(key[worded], return_index=True)
    again = np.zeros(len(ls), bool)
    again[worded] = True
    again[worded[firsts]] = False
    repeat_total = np.zeros(len(ws) + 1, np.int64)
    np.cumsum(repeated, out=repeat_total[1:])
    line_repeats = repeat_total[end_word] - repeat_total[first_word]
    counts = {
        "n_words": np.bincount(wt, minlength=n),
        "word_chars": texts.count(inked),
        "n_symbols": texts.count(_SYMBOL[data]),
        "n_dup_lines": np.bincount(lt[again], minlength=n),
        "n_repeat_words": np.bincount(wt[repeated], minlength=n),
    }
    some = np.maximum(n_words, 1)
    letters = _sums(_UPPER[data] | _LOWER[data], ls, le)
    chars = _sums(inked, ls, le)
    last = np.zeros(len(ls), bool)
    full = n_words > 0
    last[full] = _END[data[we[end_word[full] - 1] - 1]]
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(lt, minlength=n), out=offsets[1:])
    edge = np.zeros(len(ls), np.int64)
    edge[offsets[1:] - 1] = 2
    edge[offsets[:-1]] = 1
    values = {
        "words": n_words,
        "symbols": _sums(_SYMBOL[data], ls, le) / some,
        "upper": _sums(_UPPER[data], ls, le) / np.maximum(letters, 1),
        "digits": _sums(_DIGIT[data], ls, le) / np.maximum(chars, 1),
        "marks": _sums(_MARK[data], ls, le) / some,
        "length": chars / some,
        "repeats": line_repeats / some,
        "ended": last,
        "again": again,
        "edge": edge,
    }
    features, base = np.empty((len(ls), len(_CUTS)), np.int16), 0
    for g, (name, cuts) in enumerate(_CUTS.items()):
        features[:, g] = base + np.searchsorted(cuts, values[name], "right")
        base += len(cuts) + 1
    return counts, features, offsets, n_words


def _line_table(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, features, offsets, words = measure(Texts(batch.column("text")))
    cut = [slice(a, b) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return pa.RecordBatch.from_pydict(
        {
            "quality": batch.column("quality"),
            "features": [features[c].tobytes() for c in cut],
            "words": [words[c].astype(np.int32).tobytes() for c in cut],
        }
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = 1_000,
    max_lines: int = 64_000,
) -> crf.Crf:
    """Fit the line model on at most ``max_docs`` labelled documents, all lines of each.

    ``labels`` has (doc_id, quality), 1 for good; null labels are left out. The sample is
    the labelled ids with the smallest hashes, as long as their texts have ``max_lines`` lines
    together; a text of more than a sixteenth of that is passed over. Without labels the model
    calls every line content. What reaches the driver is at most ``max_lines`` rows of features.
    """
    sample = (
        labels.select("doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )
    # at most max_docs rows, so the broadcast has a known bound
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("text")]
    lines = F.regexp_count("text", F.lit("\n")) + 1
    # a bounded number of rows, so one task may add up their lines
    picked = (
        picked.withColumn("lines", F.coalesce(lines, F.lit(1)))
        .where(F.col("lines") <= max_lines // 16)
        .orderBy(*order)
        .limit(2 * max_docs)  # repeated ids in docs
        .withColumn("upto", F.sum("lines").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
        .where(F.col("upto") <= max_lines)
    )
    rows = (
        picked.select("text", "quality")
        .mapInArrow(per_chunk(_line_table, "text"), "quality int, features binary, words binary")
        .orderBy("quality", "features", "words")
        .collect()
    )
    rows = [r for r in rows if len(r.words)]
    if not rows:
        return crf.fit(np.empty((0, len(_CUTS)), np.int16), np.zeros(1, np.int64), [], N_FEATURES, 2)
    features = np.concatenate(
        [np.frombuffer(r.features, np.int16).reshape(-1, len(_CUTS)) for r in rows]
    )
    words = [np.frombuffer(r.words, np.int32) for r in rows]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    bad = np.array([r.quality == 0 for r in rows])
    labels_ = np.repeat(np.where(bad, BOILERPLATE, CONTENT), np.diff(offsets))
    model = crf.fit(features, offsets, labels_, N_FEATURES, 2)
    found = model.decode(features, offsets)
    for k in np.flatnonzero(bad):
        a, b = offsets[k], offsets[k + 1]
        if words[k][found[a:b] == CONTENT].sum() < MIN_SHARE * words[k].sum():
            labels_[a:b] = found[a:b]
    return crf.fit(features, offsets, labels_, N_FEATURES, 2)


def judge(docs: DataFrame, model: crf.Crf, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, content_share, and kept.

    Words are runs of characters other than white space (blank and the controls 9 to 13).
    A text fails the base rules with fewer than 50 words, or when more than half of its
    words lie in three-word windows that occur twice or more. ``content_share`` is the
    share of words in lines labelled content, 0 without words. Columns of ``docs`` with
    these names are replaced.
    """
    added = [
        *((c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")),
        ("n_repeat_words", "bigint"),
        ("base_failed", "boolean"),
        ("content_share", "double"),
        ("kept", "boolean"),
    ]
    names = {c.lower() for c, _ in added}
    carried = [f for f in docs.schema.fields if f.name.lower() not in names]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
        + [f"{c} {kind}" for c, kind in added]
    )
    keep = [f.name for f in carried]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, features, offsets, words = measure(Texts(batch.column(text)))
        content = words * (model.decode(features, offsets) == CONTENT)
        total = np.zeros(len(content) + 1, np.int64)
        np.cumsum(content, out=total[1:])
        n_words = counts["n_words"]
        share = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(n_words, 1)
        failed = (n_words < MIN_WORDS) | (100 * counts["n_repeat_words"] > 50 * n_words)
        columns = {c: batch.column(c) for c in keep} | {c: pa.array(v) for c, v in counts.items()}
        columns |= {
            "base_failed": pa.array(failed),
            "content_share": pa.array(share),
            "kept": pa.array(~failed & (share >= MIN_SHARE)),
        }
        return pa.RecordBatch.from_pydict(columns)

    wanted = docs.select(*[F.col(f"`{c}`") for c in keep])
    return wanted.mapInArrow(per_chunk(run, text), schema)
