"""Phrases, top-k search and whitening against brute force, and their defined cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from eventmart.llm import collocations, feast, maxscore, whitening

# --- 11: phrases


def _brute_phrases(rows, least, longest=5):
    words = Counter()
    counts = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts[lang, tuple(w[i : i + m])] += 1
    frequent = {k: a for k, a in counts.items() if a >= least}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) == 1 or any(
            q[0] == lang and len(q[1]) > len(p) and b >= a
            and any(q[1][i : i + len(p)] == p for i in range(len(q[1]) - len(p) + 1))
            for q, b in frequent.items()
        ):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * words[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, words[lang], score))
    return sorted(out)


@pytest.mark.parametrize("handed, held", [(1_000_000, 500_000), (7, 5)])
def test_phrases(spark, monkeypatch, handed, held):
    """Nulls, empty and long texts, repeats, ties, and columns with the names of results."""
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "CHUNK", 600)
    rng = random.Random(11)
    vocabulary = ["a", "B", "é", "new", "york", "x\x85y", "漢", "d\xa0e", "of"]
    rows = []
    for k in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(30))
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\r\n"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", "fr"), (" \n.", None), ("new york city " * 400, "en")]
    rows += [("in the city of new york", "de")] * 9
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "text string, lang string, n int, phrase string")
    got = collocations.phrases(df.repartition(3), least=6, handed=handed).collect()
    assert sorted(tuple(r) for r in got) == _brute_phrases(rows, 6)
    top = collocations.top_phrases(df, top=4, least=6).collect()
    by_lang = {}
    for r in _brute_phrases(rows, 6):
        by_lang.setdefault(r[0], []).append(r)
    want = []
    for found in by_lang.values():
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        want += [(r[0], k, *r[1:]) for k, r in enumerate(found[:4], 1)]
    assert sorted(tuple(r) for r in top) == sorted(want)
    assert collocations.phrases(df.limit(0)).count() == 0


def test_dense_and_sparse_tiles_count_alike(monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(-1, 40, 5000)
    ids[rng.integers(0, 5000, 500)] = rng.integers(1000, 4000, 500)
    want = Counter((a, b) for a, b in zip(ids[:-1], ids[1:]) if a >= 0 and b >= 0)
    for dense in (1, 60, 10**9):
        monkeypatch.setattr(collocations, "DENSE", dense)
        codes, times = collocations.count_pairs(ids)
        assert {(c >> 32, c & 0xFFFFFFFF): n for c, n in zip(codes, times)} == want
        assert len(set(codes.tolist())) == len(codes)


def test_scores_beyond_64_bits(spark):
    # 1000 a n passes 2^63 and l r passes 2^64
    a, n = 4_000_000_000_000, 9_000_000_000_000
    rows = [(a, [a + 5, a], [a + 7, a], n, "en", "x y")]
    df = spark.createDataFrame(
        rows, "f long, heads array<long>, tails array<long>, n long, lang string, phrase string"
    )
    assert collocations._scored(df, 2).first().score == 1000 * a * n // ((a + 5) * (a + 7))


# --- 12: search


def _brute_search(rows, k=5, every=50):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, set()).add(tuple(int(np.floor(256 * np.float64(x))) for x in v))
    out = set()
    for q, vectors in whole.items():
        if q % every:
            continue
        best = {}
        for x in vectors:
            for d, others in whole.items():
                for y in others:
                    if d != q and len(x) == len(y):
                        score = sum(a * b for a, b in zip(x, y))
                        best[d] = max(score, best.get(d, score))
        top = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]
        out |= {(q, r, d, s) for r, (d, s) in enumerate(top, 1)}
    return out


@pytest.mark.parametrize("shard, block", [(1 << 18, 4096), (40, 16)])
def test_search(spark, monkeypatch, shard, block):
    """Copies, ties, nulls, odd components, other lengths, repeated rows and ids."""
    monkeypatch.setattr(maxscore, "SHARD", shard)
    monkeypatch.setattr(maxscore, "BLOCK", block)
    monkeypatch.setattr(maxscore, "SAMPLE", 9)
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(0, 0.3, 12).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(60)] + [(400 + i, [0.0] * 12) for i in range(20)]
    rows += [(500, None), (501, [None] * 12), (502, [float("nan")] * 12), (550, [float("inf")] * 12)]
    rows += [(None, rows[3][1]), (600, [1.0, 2.0]), (601, [0.5, -1.0]), (650, [])]
    rows += [rows[100], rows[7], (150, rng.normal(0, 0.3, 12).tolist()), (651, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "1 AS rank", "2L AS score", "3 AS x")
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    got = maxscore.search(df.repartition(5))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == _brute_search(exact)
    assert maxscore.search(df.limit(0)).count() == 0


def test_search_of_large_components_is_exact():
    x = np.array([[1 << 40, 3, -5], [1 << 40, 2, 7], [-(1 << 41), 1, 1]], np.int64)
    shard = maxscore.Shard(x, np.array([5, 6, 7]), np.arange(3))
    query = np.array([1 << 21, 1, 1], np.int64)
    scores = [sum(int(a) * int(b) for a, b in zip(query, row)) for row in x]
    assert shard.best(query, 0, 3, None) == sorted(zip(scores, (5, 6, 7)), reverse=True)


# --- 13: whitening


def test_contour_integration_finds_all_pairs():
    rng = np.random.default_rng(13)
    for dims in (1, 2, 5, 20, 64):
        a = rng.standard_normal((dims, dims))
        v = a @ a.T
        values, vectors = feast.leading(v, 16)
        want = np.linalg.eigvalsh(v)[::-1][:16]
        assert np.abs(values - want).max() < 1e-12 * want[0]
        assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    repeated = np.diag([3.0] * 4 + [1.0] * 20 + [0.0] * 6)
    values, vectors = feast.leading(repeated, 16)
    assert np.allclose(values, [3.0] * 4 + [1.0] * 12)
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert len(feast.leading(np.zeros((3, 3)), 16)[0]) == 0


def test_inertia_counts():
    rng = np.random.default_rng(14)
    a = rng.standard_normal((30, 30))
    v = a + a.T
    values = np.linalg.eigvalsh(v)
    diagonal, off = feast.tridiagonal(v)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 50):
        assert feast.count_above(diagonal, off, shift) == (values > shift).sum()


def _brute_whitened(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    d = fit - sums / n
    values, q = np.linalg.eigh(d.T @ d / n)
    values, q = values[::-1], q[:, ::-1]
    keep = values > 1e-10 * values[0]
    values, q = values[keep][:16], q[:, keep][:, :16]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ q / np.sqrt(values), values


def test_whitening(spark):
    """Copies, nulls, odd components, repeated and null ids, two lengths, clashing columns."""
    rng = np.random.default_rng(15)
    long = (rng.normal(0, 1, (120, 20)) * np.linspace(0.2, 2, 20)).astype(np.float32)
    short = rng.normal(0, 1, (30, 3)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(long)] + [(200 + i, v.tolist()) for i, v in enumerate(short)]
    rows += [(300 + i, rows[4][1]) for i in range(40)] + [(4, rows[4][1]), (None, rows[5][1])]
    bad = [(500, None), (501, [None] * 20), (502, [float("nan")] * 20), (503, [float("inf")] * 3), (504, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + bad],
                               "vec_id long, embedding array<float>, n int, dims int")
    got = whitening.whiten(df.repartition(4)).collect()
    for dims, most in ((20, 16), (3, 3)):
        own = [r for r in rows if len(r[1]) == dims]
        n, deviation, white, values = _brute_whitened([v for _, v in own])
        found = [r for r in got if (r.n == n)]
        assert len(found) == len(own) * most
        by_id = {}
        for (i, _), dev, w in zip(own, deviation, white, strict=True):
            by_id[i] = (int(dev), w)
        for r in found:
            dev, w = by_id[r.vec_id]
            assert int(r.deviation) == dev
            assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
            assert r.explained == pytest.approx(values[r.component - 1] / _trace(own), rel=1e-9)
            assert r.identity_error < 1e-9
        same = {(r.vec_id, r.component): r.whitened for r in found}
        if dims == 20:
            assert len({round(same[i, 1], 12) for i in (4, 300, 339)}) == 1
    assert whitening.whiten(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(alone).count() == 0


def _trace(rows):
    x = np.unique(np.floor(64 * np.array([v for _, v in rows], np.float64)) + 1_000_000, axis=0)
    return ((x - x.mean(axis=0)) ** 2).sum() / len(x)


def test_deviations_beyond_64_bits():
    f = whitening.Fit(4_000_000_000, np.array([10**15, -7], np.int64))
    x = np.array([[5, 9], [123_456, -99]], np.int64)
    want = [sum((f.n * int(a) - int(s)) ** 2 for a, s in zip(row, f.sums)) for row in x]
    assert f.deviations(x) == want
