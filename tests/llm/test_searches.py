"""Nearest neighbours, ranked search and hard negatives against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duescope.llm import negatives, neighbours, ranked

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, row long, v string, g int, c int, score double"


def vector_rows():
    rng = random.Random(3)
    vec = lambda d=8: [float(np.float32(rng.gauss(0, 0.3))) for _ in range(d)]
    out = [(i, vec(), rng.randrange(3)) for i in range(220)]
    hot = vec()
    out += [(i, hot, 1) for i in range(300, 380)]  # more copies than neighbours are asked for
    out += [(400 + i, [float(np.float32(x + 1e-6 * i)) for x in hot], 2) for i in range(30)]
    out += [
        (600, None, 1), (601, [0.0] * 8, 1), (602, [None] + vec(7), 2), (700, [NAN] + vec(7), 1), (701, [INF] + vec(7), 1),
        (800, vec(), None), (801, [], 1), (900, vec(5), 1), (901, vec(5), 2), (902, vec(3), 0), (None, vec(), 1), (None, None, None),
    ]
    return [*out, out[100], out[100], out[200]]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 0.5) for r in vector_rows()], VECTORS)


def finite(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_nearest(rows, k):
    rows = [(i, np.array(v, np.float64)) for i, v, _ in rows if finite(v) and any(v)]
    out = []
    for n, (q, x) in enumerate(rows):
        if q is None or q % 100:
            continue
        near = []
        for m, (i, y) in enumerate(rows):
            if m != n and len(x) == len(y):
                total = 0.0
                for a, b in zip(x, y):
                    total += (a - b) * (a - b)
                near.append((math.sqrt(total), i is None, i or 0))
        out += [(q, r, None if none else i, s) for r, (s, none, i) in enumerate(sorted(near)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("tile", [(256, 2048), (3, 16)])
def test_nearest_matches_brute_force(vectors, tile, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", tile)
    got = neighbours.nearest(vectors, F.col("vec_id") % 100 == 0).collect()
    assert order(map(tuple, got)) == order(brute_nearest(vector_rows(), 10))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 3, 64, 1500]), st.sampled_from([1e-30, 1.0, 1e30]))
def test_bounds_hold_the_distances(seed, d, scale):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(5, d)) * scale, rng.normal(size=(7, d)) * scale
    b[0], b[1] = a[0], a[1] * (1 + 1e-7)
    low, high = neighbours.bounds(neighbours.encoded(a), neighbours.encoded(b))
    i, j = np.indices(low.shape)
    real = neighbours.distances(a.T[:, i.ravel()], b.T[:, j.ravel()]).reshape(low.shape)
    assert (low <= real).all() and (real <= high).all()


def test_code_products_are_exact():
    rng = np.random.default_rng(1)
    a, b = (rng.choice([-127, 127], (4, 3000)).astype(np.int8) for _ in range(2))
    assert (neighbours.products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 10**6), st.sampled_from([1, 2, 8]))
def test_strassen_is_exact(m, k, n, seed, leaf):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 28), 1 << 28, (m, k)), rng.integers(-(1 << 28), 1 << 28, (k, n))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_products_beyond_64_bits_are_an_error():
    with pytest.raises(ArithmeticError):
        list(negatives._tiles(np.full((1, 4), 1 << 31), np.full((1, 4), 1 << 31)))


def brute_mined(rows):
    rows = [(i, [math.floor(256 * x) for x in v], y if i is None or i % 7 else (y + 1) % 10)
            for i, v, y in rows if y is not None and finite(v)]
    out = []
    key = lambda p: (-p[0], p[1] is None, p[1] or 0)
    for n, (a, x, label) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(sum(s * t for s, t in zip(x, y)), i, other == label)
                  for m, (i, y, other) in enumerate(rows) if m != n and len(x) == len(y)]
        for top, p, _ in sorted((s for s in scored if s[2]), key=key)[:5]:
            fit = sorted((s for s in scored if not s[2] and 80 * top <= 100 * s[0] <= 100 * top), key=key)[:5]
            out += [(a, p, r, i, top, s) for r, (s, i, _) in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("tile", [(512, 2048), (5, 40)])
def test_negatives_match_brute_force(vectors, tile, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", tile)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mined(vectors, F.col("vec_id") % 100 == 0, label, lambda x: F.floor(x.cast("double") * 256)).collect()
    want = brute_mined(vector_rows())
    assert want and order(map(tuple, got)) == order(want)


def test_empty_vector_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert neighbours.nearest(none, F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mined(none, F.col("vec_id") % 100 == 0, F.col("label"), lambda x: F.floor(x)).count() == 0


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_ranked(docs, items, k):
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_words = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        scores = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // max(n_words, 1)
            s = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("k, width, wider", [(50, 1 << 16, 8), (3, 1 << 6, 2), (7, 1, 3)])
def test_ranked_matches_brute_force(spark, docs, doc_rows, k, width, wider, monkeypatch):
    """Down to one coordinate, where bounds tell next to nothing and many waves are needed."""
    monkeypatch.setattr(ranked, "WIDTH", width)
    monkeypatch.setattr(ranked, "WIDER", wider)
    texts = {r[0]: r[1] for r in doc_rows}
    items = [(1, texts[7]), (2, "the an er Ünï anne"), (3, ""), (4, None), (5, "nothingofthekind"), (6, texts[3][:80]), (6, texts[4][:80]),
             (2, "the an er Ünï anne"), (None, "an an re")]
    table = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, term string, row int")
    got = ranked.ranked(docs, table, k).collect()
    want = brute_ranked([(r[0], r[1]) for r in doc_rows], items, k)
    assert order(map(tuple, got)) == order(want)


def test_ranked_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "an er")], "item_id long, text string")
    assert ranked.ranked(empty, items).count() == 0
    assert ranked.ranked(docs, items.limit(0)).count() == 0
