"""The operators' methods on hand-made cases, and defined cases that need larger rows."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import crf, jaccard_join, pii_crf, quality_rules, secret_scan, suffix_dedup, toxicity
from eventmart.llm.textops import Texts

# --- linear chains


def test_best_labels_against_all_labellings():
    rng = np.random.default_rng(1)
    for labels in (2, 3):
        model = crf.Crf(
            rng.normal(0, 1, (9, labels)), rng.normal(0, 1, (labels, labels)), rng.normal(0, 1, labels)
        )
        offsets = np.array([0, 1, 1, 6, 11])
        features = rng.integers(0, 3, (11, 3)) + [0, 3, 6]
        emit = model.emissions(features)
        got = model.decode(features, offsets)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            def total(path, a=a):
                score = model.first[path[0]] + sum(emit[a + t, y] for t, y in enumerate(path))
                return score + sum(model.trans[x, y] for x, y in zip(path, path[1:]))

            if b > a:
                best = max(product(range(labels), repeat=b - a), key=total)
                assert tuple(got[a:b]) == best


def test_runs_between_certain_rows_decode_like_whole_sequences():
    rng = np.random.default_rng(2)
    for _ in range(20):
        model = crf.Crf(rng.normal(0, 2, (12, 4)), rng.normal(0, 1, (4, 4)), rng.normal(0, 1, 4))
        model.weights[:6, 0] += 6
        cuts = np.sort(rng.integers(0, 300, 9))
        offsets = np.r_[0, cuts, 300]
        features = np.stack([rng.integers(0, 6, 300), 6 + rng.integers(0, 6, 300)], 1)
        want = model.decode(features, offsets)
        assert (model.decode_sparse(features, offsets) == want).all()


# --- 3: hot seeds, long texts, clashing columns


def _prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(60)}" for _ in range(n))


def test_a_seed_of_more_places_than_one_task_compares(spark, monkeypatch):
    """One passage in all texts, with variants that share more or less of what follows."""
    monkeypatch.setattr(suffix_dedup, "DEALT", 8)
    core = _prose("core", 45)
    texts = {}
    for k in range(90):
        texts[k] = f"{_prose(f'head{k % 5}', k % 7)} {core} {_prose(f'tail{k % 11}', 12)} {_prose(k, 30)}"
    texts[200] = f"{_prose('long', 30_000)} {core} {_prose('tail3', 12)}"
    df = spark.createDataFrame(
        [(k, t, 1, "x") for k, t in texts.items()], "doc_id long, text string, at int, seed string"
    )
    words = {k: t.split() for k, t in texts.items()}
    windows = {}
    for k, w in words.items():
        for i in range(len(w) - 49):
            windows.setdefault(tuple(w[i : i + 50]), []).append((k, i))
    want = {k: set() for k in texts}
    for places in windows.values():
        if len(places) > 1:
            for k, i in places:
                want[k] |= set(range(i, i + 50))
    for r in suffix_dedup.repeated_spans(df.repartition(4)).collect():
        t = texts[r.doc_id]
        got = set()
        for s in r.spans:
            a = len(t[: s.start].split())
            got |= set(range(a, a + s.words))
        assert got == want[r.doc_id]


def test_neighbours_in_suffix_order():
    rng = np.random.default_rng(3)
    group = np.sort(rng.integers(0, 5, 200))
    right = rng.integers(0, 3, (200, suffix_dedup.SIDE)).astype(np.uint64) << np.uint64(20)
    order = suffix_dedup._suffix_order(group, right)
    keys = [(int(group[i]), *right[i].tolist()) for i in order]
    assert keys == sorted(keys)


# --- 4: notations

SECRET = "Zx9kLm2Qp7Rt"


@pytest.mark.parametrize(
    "text",
    [
        f"k='{SECRET}'\nsecretKey = k",
        f"secretKey = k\nk = '{SECRET}'",
        f"db_pwd = base + '{SECRET}'",
        f"db_pwd = base+'{SECRET}'",
        f"define('DB_PASSWORD', '{SECRET}')",
        f"os.environ.setdefault('DB_PWD', \"{SECRET}\")",
        f"tool --passphrase {SECRET} --verbose",
        f"tool --passphrase={SECRET}",
        f"<db><passphrase>{SECRET}</passphrase></db>",
        f"passphrase: |\n  {SECRET}\nnext: 1",
        f"- passphrase: >-\n    {SECRET}",
        f"{'n' * 300}_pwd = '{SECRET}'",
        f"db_pwd = b'{SECRET}'",
    ],
)
def test_the_literal_is_found_where_it_stands(text):
    assert [text[a:b] for _, a, b in secret_scan.pair_spans(text)] == [SECRET]


def test_what_is_no_secret():
    for text in (
        "x = f('password', 3)", "authKey = other_function(3)", f"if token == '{SECRET}': pass",
        f"db_pwd = base + other('{SECRET}')", "passphrase: |\nnext: 1", "<passphrase></passphrase>",
    ):
        assert secret_scan.pair_spans(text) == [], text


def test_secrets_in_repeated_and_very_long_rows(spark):
    long = f"{_prose('l', 60_000)}\ndb_pwd = '{SECRET}'"
    df = spark.createDataFrame([(1, long), (1, long), (2, None)], "doc_id long, text string")
    got = [[long[s.start : s.end] for s in r.spans] for r in secret_scan.scan(df).collect()]
    assert sorted(got) == [[], [SECRET], [SECRET]]


# --- 6: personal data


def _like(text):
    model, shapes = pii_crf.train(), pii_crf.Shapes()
    return [text[a:b] for _, a, b in pii_crf.model_spans(Texts(pa.array([text])), model, shapes)[0]]


def test_numbers_and_addresses_without_base_form():
    assert _like("reach me at 917 555 0192 tonight") == ["917 555 0192"]
    assert _like("Rufen Sie 030 5550 1122 an") == ["030 5550 1122"]
    assert _like("send it to kim AT post DOT de please") == ["kim AT post DOT de"]
    assert _like("schreib an eva at web punkt de bitte") == ["eva at web punkt de"]
    assert _like("In 1998 the price rose by 14 percent") == []


def test_the_labelled_table_is_read_as_marked():
    words, labels = pii_crf.labelled()
    by_row = [" ".join(w for w, y in zip(*row) if y) for row in zip(words, labels)]
    assert "k_lee[AT]lab[DOT]org" in by_row and not any("[email" in w for r in words for w in r)


def test_the_model_on_rows_it_has_not_seen():
    """Ten folds of the table: spans found whole."""
    lines = pii_crf.EXAMPLES.strip().splitlines()
    random.Random(1).shuffle(lines)
    hit = found = there = 0
    shapes = pii_crf.Shapes()
    for fold in range(10):
        model = pii_crf.train("\n".join(x for i, x in enumerate(lines) if i % 10 != fold))
        words, labels = pii_crf.labelled("\n".join(x for i, x in enumerate(lines) if i % 10 == fold))
        offsets = np.cumsum([0, *map(len, words)])
        shape = np.array([shapes.of(w) for row in words for w in row])
        got = model.decode(pii_crf.features_of(shape, offsets), offsets)
        for (a, b), row in zip(zip(offsets[:-1], offsets[1:]), labels):
            one, two = (
                {
                    (i, next((j for j in range(i, len(y)) if y[j] != y[i]), len(y)), y[i])
                    for i in range(len(y)) if y[i] and (i == 0 or y[i - 1] != y[i])
                }
                for y in (got[a:b].tolist(), row)
            )
            hit, found, there = hit + len(one & two), found + len(one), there + len(two)
    assert hit / found > 0.75 and hit / there > 0.75


def test_personal_data_in_repeated_long_and_clashing_rows(spark):
    long = f"{_prose('l', 50_000)} call 917 555 0192 now"
    df = spark.createDataFrame([(1, long, 5), (1, long, 5), (2, "", 5)], "doc_id long, text string, spans int")
    got = pii_crf.scan(df).collect()
    assert sorted([long[s.start : s.end] for s in r.spans] for r in got) == [[], ["917 555 0192"], ["917 555 0192"]]


# --- 7: whole documents are learned


def test_lines_behind_the_first_are_learned(spark):
    lines = [_prose(k, 12) + "." for k in range(60)]
    good = [(k, "\n".join(lines[k % 7 :])) for k in range(40)]
    footer = "\n".join(["# # | * $"] * 90)
    bad = [(100 + k, "\n".join([*lines[: 35 + k % 3], footer])) for k in range(40)]
    rows = good + bad
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in rows], "doc_id long, quality int")
    model = quality_rules.train(df, labels)
    mixed = "\n".join([*lines[:40], *["# # | * $"] * 10])
    _, features, offsets, _ = quality_rules.measure(Texts(pa.array([mixed])))
    found = model.decode(features, offsets)
    assert (found[:40] == quality_rules.CONTENT).mean() > 0.9
    assert (found[40:] == quality_rules.BOILERPLATE).mean() > 0.9
    few = quality_rules.train(df, labels, max_lines=1600)
    assert few.weights.shape == model.weights.shape
    same = spark.createDataFrame([rows[0]] * 3, "doc_id long, text string")
    assert {tuple(r) for r in quality_rules.judge(same, model).drop("text").collect()}.__len__() == 1


# --- 9: the grammar against plain Python


def _plain_features(text, words):
    """What ``features`` measures, clause by clause; ``words`` maps words to classes."""
    counts = dict.fromkeys(toxicity._READINGS, 0)
    clauses = asserted = denied = 0
    for clause in "".join("\0" if c in ".,;:!?\n" else c for c in text.lower()).split("\0"):
        kinds = [words.get(w, toxicity.OTHER) for w in clause.split()]
        clauses += bool(kinds)
        left = reported = 0
        seen, flags = set(), set()
        for k in kinds:
            if k in (toxicity.INSULT, toxicity.THREAT):
                seen.add("insult" if k == toxicity.INSULT else "threat")
                flags |= {"_negated"} if left else set()
                flags |= {"_reported"} if reported else set()
            if k == toxicity.TARGET:
                flags.add("_target")
            reported = reported or k == toxicity.REPORT
            left = 3 if k == toxicity.NEGATION else max(left - 1, 0)
        reading = next((f for f in ("_negated", "_reported", "_target") if f in flags), "")
        for kind in seen:
            counts[kind + reading] += 1
        if seen:
            denied += reading in ("_negated", "_reported")
            asserted += reading not in ("_negated", "_reported")
    values = [*counts.values(), sum(counts.values())]
    shares = [100 * x / max(clauses, 1) for x in (asserted, denied)]
    return np.log1p(np.array([*values, *shares], float))


def _grammar(words):
    hashes = {int(toxicity._hash_of(w)): k for w, k in words.items()}
    order = sorted(hashes)
    return toxicity.Grammar(
        np.array(order, np.uint64), np.array([hashes[h] for h in order], np.int8),
        np.zeros(len(order), bool), np.zeros(toxicity.N_FEATURES), 0.0,
    )


def test_features_are_those_of_matched_clauses():
    words = {w: k for k, ws in toxicity.WORDS.items() for w in ws} | {
        "grobnik": toxicity.INSULT, "zulf": toxicity.INSULT, "smite": toxicity.THREAT,
    }
    rng = random.Random(9)
    some = [*random.Random(2).sample(sorted(words), 25), "grobnik", "smite", "you", "not", "said"]
    texts = ["not grobnik", "you grobnik", "", "no bad word here. None.", "he said you grobnik"]
    for _ in range(200):
        texts.append("".join(
            rng.choice([rng.choice(some), _prose(rng.random(), 1)]) + rng.choice([" ", " ", " ", ". ", ", ", "\n"])
            for _ in range(rng.randrange(30))
        ))
    got = toxicity.features(Texts(pa.array(texts), lower=True), _grammar(words))
    want = np.array([_plain_features(t, words) for t in texts])
    assert np.abs(got - want).max() < 1e-12
    assert got[0, -2] == 0 < got[1, -2] and got[0, -1] > 0 == got[1, -1]


def _labelled(spark, flip=()):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(400):
        words = _prose(k, 40).split()
        if toxic := k % 4 == 0:
            at = rng.randrange(30)
            words[at:at] = rng.choice([["you", "grobnik"], ["i", "will", "smitenow", "you"]])
        rows.append((k, " ".join(words)))
        marks.append((k, int(toxic) if k not in flip else 1 - int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(marks, "doc_id long, toxic int"),
    )


def test_threats_and_insults_are_both_learned(spark):
    docs, labels = _labelled(spark)
    grammar = toxicity.train(docs, labels)
    classes = {int(h): int(k) for h, k in zip(grammar.hashes, grammar.classes)}
    assert classes[int(toxicity._hash_of("grobnik"))] == toxicity.INSULT
    assert classes[int(toxicity._hash_of("smitenow"))] == toxicity.THREAT


def test_held_out_labels_change_no_score(spark):
    docs, labels = _labelled(spark)
    out = [r.doc_id for r in docs.select("doc_id").where(toxicity.held_out("doc_id")).collect()]
    assert len(out) > 40
    _, flipped = _labelled(spark, flip=set(out))
    one, two = (
        sorted(tuple(r) for r in toxicity.score(docs, toxicity.train(docs, m)).select("doc_id", "score").collect())
        for m in (labels, flipped)
    )
    assert one == two


def test_toxicity_of_very_long_texts(spark):
    docs, labels = _labelled(spark)
    grammar = toxicity.train(docs, labels)
    long = " ".join(["x" + _prose(k, 1) for k in range(80_000)])
    rows = [(1, long), (2, f"{long}. you grobnik. " + "you grobnik. " * 3000), (3, None)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), grammar).collect()}
    assert got[2] > got[1]


# --- 10: carried runs


def test_a_carried_run_keeps_its_last_row(monkeypatch):
    monkeypatch.setattr(jaccard_join, "HELD", 4)

    def batch(docs):
        n = len(docs)
        return pa.RecordBatch.from_pydict(
            {"shingle": pa.array([7] * n, pa.int64()), "n": pa.array([50] * n, pa.int32()),
             "doc_id": pa.array(docs, pa.int64())}
        )

    after = pa.RecordBatch.from_pydict(
        {"shingle": pa.array([8, 8], pa.int64()), "n": pa.array([50, 50], pa.int32()),
         "doc_id": pa.array([1, 2], pa.int64())}
    )
    for batches in ([batch([1, 2, 3, 4, 5]), batch([500])], [batch([1, 2, 3, 4, 5]), batch([500]), after]):
        rows = [r for b in jaccard_join._tiles(iter(batches)) for r in b.to_pylist()]
        assert {r["y"] for r in rows if r["kind"] == 1 and r["x"] == 7} == {1, 2, 3, 4, 5, 500}
        assert not [r for r in rows if r["kind"] == 1 and r["x"] == 8]


# --- 10: pairs of a unit


@pytest.mark.parametrize("block", [3, 512])
def test_a_unit_of_uneven_sets_gives_the_pairs_within_the_bound_of_whole_bitmaps(monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(10)

    def fresh(n):
        return rng.integers(0, 2**64, n, np.uint64)

    sets = [fresh(n) for n in (9, 12, 33, 40, 900, 1000, 1100, 3000, 3000, 3100, 3300, 9000, 9100)]
    sets += [np.r_[s[k:], fresh(k)] for s, k in ((sets[3], 2), (sets[6], 60), (sets[8], 200), (sets[12], 100))]
    sets = dict(enumerate(sorted(sets, key=len)))
    bits = {i: jaccard_join._bitmap(s).tobytes() for i, s in sets.items()}
    within = {
        (i, j)
        for i, j in product(sets, sets)
        if i < j and 100 * len(sets[i]) >= 80 * len(sets[j])
        and 180 * jaccard_join.overlap_bound(bits[i], bits[j], len(sets[i]), len(sets[j]))
        >= 80 * (len(sets[i]) + len(sets[j]))
    }
    near = {(i, j) for i, j in within if len(np.intersect1d(sets[i], sets[j])) > 0.8 * len(sets[i])}
    assert len(near) == 4
    for crossed in (False, True):
        rows = [
            {"unit": 0, "g1": 0, "g2": int(crossed), "n": len(s), "comp": i, "side": i % 2 * crossed,
             "doc_id": i, "bitmap": bits[i]}
            for i, s in sets.items()
        ]
        asked = {(i, j) for i, j in within if not crossed or i % 2 != j % 2}
        for nearest in (False, True):
            batches = jaccard_join._blocks(nearest)(iter([pa.RecordBatch.from_pylist(rows)]))
            got = {(r["a"], r["b"]) for b in batches for r in b.to_pylist()}
            assert got == asked if not nearest else near & asked <= got <= asked
