"""Agglomerative trees against one merge at a time."""

import random
from itertools import combinations

import numpy as np
import pytest

from duescope.operators import linkage
from duescope.operators import similarity as sim


def points(n, seed, ties=False):
    rng = random.Random(seed)
    return {f"C{i:02d}": [float(rng.randrange(4)) if ties else rng.gauss(0, 1) for _ in range(3)] for i in range(n)}


def pair_table(spark, where):
    rows = [(a, b, float(np.linalg.norm(np.subtract(where[a], where[b])))) for a in where for b in where if a != b]
    return spark.createDataFrame(rows, "country string, neighbor string, dist_eucl double")


def height(where, a, b, method):
    x, y = np.array([where[i] for i in a]), np.array([where[i] for i in b])
    if method == "ward":
        gap = x.mean(axis=0) - y.mean(axis=0)
        return float(np.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * (gap @ gap)))
    away = np.linalg.norm(x[:, None] - y[None], axis=2)
    return float(away.mean() if method == "average" else away.max())


def one_at_a_time(where, method):
    """Merges (members, members, height), and the cophenetic distance of each pair."""
    clusters, out, shared = [frozenset([c]) for c in where], [], {}
    while len(clusters) > 1:
        h, a, b = min(((height(where, a, b, method), *sorted((a, b), key=min)) for a, b in combinations(clusters, 2)),
                      key=lambda t: (round(t[0], 9), min(t[1]), min(t[2])))
        shared |= {p: h for x in a for y in b for p in ((x, y), (y, x))}
        clusters = [c for c in clusters if c not in (a, b)] + [a | b]
        out.append((min(min(a), min(b)), max(min(a), min(b)), h))
    return out, shared


@pytest.mark.parametrize("method", linkage.METHODS)
@pytest.mark.parametrize("n, seed", [(2, 1), (9, 2), (23, 3)])
def test_merges_and_cophenetic_distances(spark, method, n, seed):
    where = points(n, seed)
    pairs = pair_table(spark, where)
    tree = linkage.merges(pairs, method)
    want, shared = one_at_a_time(where, method)
    got = sorted((r.lo, r.hi, r.height) for r in tree.collect())
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert np.allclose([g[2] for g in got], [w[2] for w in sorted(want)])
    kept = {(r.country, r.neighbor): r.height for r in linkage.cophenetic(tree).collect()}
    assert kept.keys() == shared.keys() and all(np.isclose(kept[p], shared[p]) for p in shared)
    d = {(r.country, r.neighbor): r.dist_eucl for r in pairs.collect()}
    order = sorted(d)
    faithful = pairs.limit(1).select(linkage.cophenetic_correlation(tree, pairs).alias("c")).first()["c"]
    if n > 2:
        assert np.isclose(faithful, np.corrcoef([d[p] for p in order], [shared[p] for p in order])[0, 1])


def test_labels_cut_the_tree(spark):
    where = {f"C{i:02d}": [10.0 * (i % 3) + 0.1 * i, 0.0, 0.0] for i in range(12)}
    pairs = pair_table(spark, where)
    names = spark.createDataFrame([(c,) for c in where], "country string")
    tree = linkage.merges(pairs)
    for k in (1, 3, 12):
        found = {r.country: r.cluster for r in linkage.labels(tree, names, k).collect()}
        assert len(found) == 12 and len(set(found.values())) == k
        if k == 3:
            assert all((found[a] == found[b]) == (int(a[1:]) % 3 == int(b[1:]) % 3) for a in where for b in where)


def test_equal_distances_and_single_entities(spark):
    where = points(14, 5, ties=True)
    for method in linkage.METHODS:
        tree = linkage.merges(pair_table(spark, where), method)
        assert tree.count() == 13 and tree.select("hi").distinct().count() == 13
    none = pair_table(spark, {"A": [0.0]})
    alone = spark.createDataFrame([("A",)], "country string")
    assert linkage.merges(none).count() == 0
    assert [tuple(r) for r in linkage.labels(linkage.merges(none), alone, 1).collect()] == [("A", 0)]


def test_score_has_the_cophenetic_term(spark):
    sil = spark.createDataFrame([("a", 0, 0.5), ("b", 0, 0.5), ("c", 1, 0.3), ("d", 1, 0.3)], "country string, cluster int, silhouette double")
    assert np.isclose(sim.clustering_score(sil, 0.9).first()["score"], 0.4 + 0.27)
    assert np.isclose(sim.clustering_score(sil).first()["score"], 0.4)
