"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon maps words to classes: insult, threat, target, negation, report and other. Small
transducers read classes and write events: one notes insults, one threats, one whether a
target was addressed, one whether a negation holds, one whether speech is reported. Their
composition reads a clause once and names the clause's reading, such as a plain insult, an
insult of a target, or a negated or reported one. Readings, not words, carry weights; a text
scores by the weighted number of its matched clauses.

The grammar's shape and a few function words are given. Which words and which beginnings of
words insult or threaten is learned from labelled texts, as are the weights of the readings: an
entry that is mostly followed by a target, as in a deed done to someone, is a threat, any other
an insult. Labels, language, source and ids are never inputs of a score. At most ``max_docs``
labelled documents are used, those with the smallest hashes of their ids; the lexicon learned
from them has no other bound.

Defined cases: a null or empty text has no clause and gets the score of such texts; repeated
rows give equal scores; extra columns pass through, but for those named like added columns,
which are replaced. Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.textops import LOWER, Texts, hash_ranges, per_chunk

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Function words of four languages.
WORDS = {
    TARGET: "you your yours u they them he she him her du dich dir ihr euch sie tu te toi vous "
    "vos votre ti tus usted ustedes ellos".split(),
    NEGATION: "not no never isn't aren't wasn't don't doesn't nicht kein keine nie ne pas "
    "jamais nunca ni".split(),
    REPORT: "said says say told wrote writes claimed called calls quoted reported sagte sagt "
    "schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split(),
    THREAT: "kill hurt destroy murder shoot stab töten tuer matar".split(),
}
#: A learned entry is seen in at least so many toxic texts, and so much more often in them.
LEAST_TEXTS, LEAST_RATIO = 4, 12.0
#: Beginnings of words that are tried as entries, in characters.
STEMS = (2, 3, 4, 5, 6, 7)
#: A threat is followed by a target within so many words of its clause, at least so many times
#: in toxic texts, and so much more often than it follows one.
NEAR, LEAST_AIMED, AIMED_RATIO = 2, 2, 2

_CLAUSE_END = np.zeros(256, bool)
_CLAUSE_END[np.frombuffer(b".,;:!?\n", np.uint8)] = True
_TRIM = np.zeros(256, bool)
_TRIM[np.frombuffer(b".,;:!?\"'()[]{}*#%&$|<>-", np.uint8)] = True

# --- transducers: {(state, class): (state, event)}; a missing pair stays and writes nothing


def _once(kind: int, event: str) -> dict:
    return {(0, kind): (1, event), (1, kind): (1, event)}


_INSULTS = _once(INSULT, "insult")
_THREATS = _once(THREAT, "threat")
_TARGETS = _once(TARGET, "target")
# A negation holds for the three words after it.
_NEGATIONS = {(s, NEGATION): (3, "") for s in range(4)} | {
    (s, c): (s - 1, "negated" if c in (INSULT, THREAT) else "")
    for s in (1, 2, 3)
    for c in (OTHER, INSULT, THREAT, TARGET, REPORT)
}
# Reported speech lasts until the clause ends.
_REPORTS = {(0, REPORT): (1, ""), (1, REPORT): (1, "")} | {
    (1, c): (1, "reported") for c in (INSULT, THREAT)
}
_PARTS = (_INSULTS, _THREATS, _TARGETS, _NEGATIONS, _REPORTS)


def compose() -> tuple[np.ndarray, np.ndarray]:
    """One machine from all transducers: next state, and event bits, by state and class.

    Only states reachable from the start are numbered.
    """
    bits = {"": 0, "insult": 1, "threat": 2, "target": 4, "negated": 8, "reported": 16}
    start = (0,) * len(_PARTS)
    numbers, todo, rows = {start: 0}, [start], []
    while todo:
        state = todo.pop(0)
        row = []
        for kind in range(6):
            moves = [p.get((s, kind), (s, "")) for p, s in zip(_PARTS, state, strict=True)]
            to = tuple(s for s, _ in moves)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append((numbers[to], sum(bits[e] for e in {e for _, e in moves})))
        rows.append(row)
    table = np.array(rows)
    return table[:, :, 0], table[:, :, 1]


_READINGS = [k + m for k, m in product(("insult", "threat"), ("", "_target", "_negated", "_reported"))]
#: What a text is scored by: logarithms of the clauses of each reading, of all matched clauses,
#: and of the shares of clauses that assert, and that negate or report, something.
N_FEATURES = len(_READINGS) + 3


@dataclass
class Grammar:
    hashes: np.ndarray  # sorted hashes of lexicon entries
    classes: np.ndarray  # their classes
    stems: np.ndarray  # whether an entry is a beginning of words
    weights: np.ndarray
    bias: float


def _clean_words(texts: Texts):
    """Lower-cased words without marks around them, their text, and the clause they are in."""
    starts, ends, text = texts.words()
    data = texts.data
    stop = _CLAUSE_END[data]
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stop, out=total[1:])
    for _ in range(4):
        open_ = (ends > starts) & _TRIM[data[np.minimum(starts, len(data) - 1)]]
        starts = starts + open_
        close = (ends > starts) & _TRIM[data[np.maximum(ends - 1, 0)]]
        ends = ends - close
    some = ends > starts
    starts, ends, text = starts[some], ends[some], text[some]
    # marks before the word, counted from the start of all data, number its clause
    clause = total[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (clause[1:] != clause[:-1]) | (text[1:] != text[:-1])
    return starts, ends, text, np.cumsum(fresh) - 1


def _stem_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int) -> np.ndarray:
    """End of the first ``chars`` characters of each word; past the end where it is shorter."""
    at = starts.copy()
    size = np.ones(256, np.int64)
    size[0xC0:0xE0], size[0xE0:0xF0], size[0xF0:] = 2, 3, 4
    for _ in range(chars):
        inside = at < ends
        at = at + np.where(inside, size[data[np.minimum(at, len(data) - 1)]], len(data) + 1)
    return at


def _entries(data, starts, ends):
    """For words and for each stem length: rows it applies to, hashes, and ends of entries."""
    yield 0, np.arange(len(starts)), hash_ranges(data, starts, ends), ends
    for chars in STEMS:
        stop = _stem_ends(data, starts, ends, chars)
        rows = np.flatnonzero(stop < ends)
        hashes = hash_ranges(data, starts[rows], stop[rows])
        yield chars, rows, hashes * np.uint64(2 * chars + 1) + np.uint64(chars), stop[rows]


def features(texts: Texts, grammar: Grammar) -> np.ndarray:
    """One row of measures for each text."""
    starts, ends, text, clause = _clean_words(texts)
    out = np.zeros((texts.n, N_FEATURES))
    if not len(starts) or not len(grammar.hashes):
        return out
    kinds = np.zeros(len(starts), np.int8)
    longest = len(grammar.hashes) - 1
    for chars, rows, hashes, _ in _entries(texts.data, starts, ends):
        at = np.minimum(np.searchsorted(grammar.hashes, hashes), longest)
        hit = (grammar.hashes[at] == hashes) & (grammar.stems[at] == (chars > 0))
        hit &= kinds[rows] == OTHER
        kinds[rows[hit]] = grammar.classes[at[hit]]
    bad = (kinds == INSULT) | (kinds == THREAT)
    n_clauses = int(clause[-1]) + 1
    matched = np.flatnonzero(np.bincount(clause[bad], minlength=n_clauses))
    if not len(matched):
        return out
    first = np.searchsorted(clause, matched, "left")
    last = np.searchsorted(clause, matched, "right")
    to, says = compose()
    state, events = np.zeros(len(matched), np.int64), np.zeros(len(matched), np.int64)
    owner = text[first]
    # words of classes only: others merely count down a negation
    for k in range(int((last - first).max())):
        on = np.flatnonzero(first + k < last)
        kind = kinds[first[on] + k].astype(np.int64)
        events[on] |= says[state[on], kind]
        state[on] = to[state[on], kind]
    named = np.zeros((len(matched), len(_READINGS)), bool)
    for base, bit in ((0, 1), (4, 2)):
        there = (events & bit) > 0
        negated, reported = (events & 8) > 0, (events & 16) > 0
        target = (events & 4) > 0
        named[:, base + 2] = there & negated
        named[:, base + 3] = there & reported & ~negated
        named[:, base + 1] = there & target & ~negated & ~reported
        named[:, base] = there & ~target & ~negated & ~reported
    counts = np.stack(
        [np.bincount(owner[named[:, k]], minlength=texts.n) for k in range(len(_READINGS))], 1
    )
    asserted = named[:, [0, 1, 4, 5]].any(axis=1)
    fresh = np.r_[True, clause[1:] != clause[:-1]]
    clauses = np.maximum(np.bincount(text[fresh], minlength=texts.n), 1)
    out[:, : len(_READINGS)] = np.log1p(counts)
    out[:, -3] = np.log1p(counts.sum(axis=1))
    for column, some in ((-2, asserted), (-1, ~asserted)):
        share = np.bincount(owner[some], minlength=texts.n) / clauses
        out[:, column] = np.log1p(100 * share)
    return out


def _hash_of(word: str) -> np.uint64:
    data = LOWER[np.frombuffer(word.encode(), np.uint8)]
    return hash_ranges(data, np.array([0]), np.array([len(data)]))[0]


def _aimed(targets: np.ndarray, clause: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a target stands within ``NEAR`` words after, and before, each word of a clause."""
    after, before = np.zeros((2, len(targets)), bool)
    for k in range(1, NEAR + 1):
        same = clause[k:] == clause[:-k]
        after[:-k] |= same & targets[k:]
        before[k:] |= same & targets[:-k]
    return after, before


def _seen(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Entries of the batch: (entry, chars), the toxic and other texts that hold it, and its
    places in toxic texts with a target after and before it."""
    texts = Texts(batch.column("text"), lower=True)
    toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
    starts, ends, text, clause = _clean_words(texts)
    known = np.sort(np.array([_hash_of(w) for w in WORDS[TARGET]], np.uint64))
    found = [[np.empty(0, kind)] for kind in (np.uint64, np.int32, np.int64, np.int64, np.int64)]
    after = before = None
    for chars, rows, hashes, _ in _entries(texts.data, starts, ends):
        if after is None:  # whole words come first
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            after, before = _aimed(known[at] == hashes, clause)
        for held, part in zip(
            found,
            (hashes, np.full(len(rows), chars, np.int32), text[rows], after[rows], before[rows]),
            strict=True,
        ):
            held.append(part)
    key, chars, owner, after, before = (np.concatenate(c) for c in found)
    # summed within the batch before it is shuffled
    order = np.lexsort((owner, key, chars))
    key, chars, owner, after, before = (c[order] for c in (key, chars, owner, after, before))
    new = np.r_[True, (key[1:] != key[:-1]) | (chars[1:] != chars[:-1])][: len(key)]
    once = new | np.r_[True, owner[1:] != owner[:-1]][: len(key)]
    first = np.flatnonzero(new)
    bad = toxic[owner] if len(owner) else owner

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.int64), first) if len(first) else first

    return pa.RecordBatch.from_pydict(
        {
            "entry": key[first].view(np.int64),
            "chars": chars[first],
            "bad": total(once * bad),
            "good": total(once * (1 - bad)),
            "after": total(after * bad),
            "before": total(before * bad),
        }
    )


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000) -> Grammar:
    """Learn the lexicon and weights from rows that are not held out.

    What reaches the driver is bounded by ``max_docs``: its rows of measures, and the entries
    that ``LEAST_TEXTS`` of its texts hold. Without labels the grammar knows its given words alone and scores 0.5.
    """
    sample = (
        labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )
    # at most max_docs rows, so the broadcast has a known bound
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    picked = picked.select("text", "toxic")
    sizes = picked.agg(F.count("*"), F.sum("toxic")).first()
    n_bad = sizes[1] or 0
    n_good = sizes[0] - n_bad
    counts = (
        picked.mapInArrow(
            per_chunk(_seen, "text"),
            "entry bigint, chars int, bad bigint, good bigint, after bigint, before bigint",
        )
        .groupBy("entry", "chars")
        .agg(*[F.sum(c).alias(c) for c in ("bad", "good", "after", "before")])
    )
    ratio = (F.col("bad") / max(n_bad, 1)) / ((F.col("good") + 0.5) / max(n_good, 1))
    top = (
        counts.where(F.col("bad") >= LEAST_TEXTS)
        .withColumn("ratio", ratio)
        .where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "entry", "chars")
        .collect()
    )
    known = {int(_hash_of(w)): (kind, False) for kind, words in WORDS.items() for w in words}
    for row in top:
        aimed = row.after >= LEAST_AIMED and row.after > AIMED_RATIO * row.before
        known.setdefault(row.entry & (2**64 - 1), (THREAT if aimed else INSULT, row.chars > 0))
    order = sorted(known)
    grammar = Grammar(
        np.array(order, np.uint64),
        np.array([known[h][0] for h in order], np.int8),
        np.array([known[h][1] for h in order], bool),
        np.zeros(N_FEATURES),
        0.0,
    )
    rows = (
        picked.mapInArrow(per_chunk(_measured(grammar), "text"), "toxic int, x binary")
        .orderBy("x", "toxic")
        .limit(2 * max_docs)  # repeated ids in docs
        .toArrow()
    )
    if not rows.num_rows:
        return grammar
    x = np.stack([np.frombuffer(v, np.float64) for v in rows.column("x").to_pylist()])
    y = rows.column("toxic").to_numpy().astype(np.float64)
    grammar.weights, grammar.bias = _logistic(x, y)
    return grammar


def _measured(grammar: Grammar):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(Texts(batch.column("text"), lower=True), grammar)
        packed = pa.array([row.tobytes() for row in x], pa.binary())
        return pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "x": packed})

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30):
    """Newton's method with a ridge penalty on all but the bias."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - penalty * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (int, 1 from 0.5 on)."""
    carried = [f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")]
    keep = [f.name for f in carried]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
        + ["score double", "predicted int"]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(Texts(batch.column(text), lower=True), grammar)
        p = 1 / (1 + np.exp(-np.clip(x @ grammar.weights + grammar.bias, -30, 30)))
        columns = {c: batch.column(c) for c in keep}
        columns |= {"score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))}
        return pa.RecordBatch.from_pydict(columns)

    wanted = docs.select(*[F.col(f"`{c}`") for c in keep])
    return wanted.mapInArrow(per_chunk(run, text), schema)
