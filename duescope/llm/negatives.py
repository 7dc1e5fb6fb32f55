"""Hard negatives from exact integer inner products, multiplied by Strassen's scheme.

Anchors and rows are dealt over a grid of cells. A cell's products are tiles of int64, padded with
zeros to even sizes and multiplied by seven half-sized products instead of eight, down to leaves.
Integer addition is exact, and where intermediate sums leave 64 bits they come back, so a score
that fits is right.

First the products of rows with the anchor's label: each cell keeps a heap of the best positives
of an anchor, and heaps merge. Then the products of rows with another label: each positive opens a
window of scores below its own, and each cell keeps a heap of the best rows in each window; these
heaps merge likewise.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescope.llm.grid import joined, matrices, numbered
from duescope.storage import stored

GROUP, CHUNK = 8_192, 16_384  # anchors and rows of a cell, about
TILE = (512, 2_048)  # anchors and rows that are multiplied at once
LEAF = 32  # matrices no wider than this in one direction are multiplied plainly
POSITIVES, NEGATIVES = 5, 5
WINDOW = (80, 100)  # least and most percent of the positive's score
NO_ID = (1 << 63) - 1  # sorts a null id behind the others
PAIRS = "anchor_row long, anchor_id long, label long, other_row long, other_id long, score long"
MINED = "anchor_row long, positive_row long, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def _even(a: np.ndarray) -> np.ndarray:
    return np.pad(a, [(0, n % 2) for n in a.shape]) if a.shape[0] % 2 or a.shape[1] % 2 else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    (i, j), l = (x // 2 for x in a.shape), b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def _checked(a: np.ndarray, b: np.ndarray) -> None:
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    if a.shape[1] * most[0] * most[1] * WINDOW[1] >= 1 << 63:
        raise ArithmeticError("an inner product may not fit into 64 bits")


def _tiles(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first anchor, first row, scores) tile by tile."""
    _checked(a, b)
    for i in range(0, len(a), TILE[0]):
        for j in range(0, len(b), TILE[1]):
            yield i, j, strassen(a[i:i + TILE[0]], np.ascontiguousarray(b[j:j + TILE[1]].T))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` highest scores, ties by smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _sides(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places and values of anchors and rows of equal lengths."""
    there = matrices(rows, "v")
    for d, (at, a) in matrices(anchors, "v").items():
        if d in there:
            yield at, a, *there[d]


def _positives(anchors: pa.Table, rows: pa.Table) -> list[tuple]:
    heaps: dict[int, list[tuple[int, int, int]]] = {}
    a_row, r_row, a_label, r_label = (t.column(c).to_numpy() for c in ("row", "label") for t in (anchors, rows))
    a_id = anchors.column("vec_id").to_numpy()
    ids = rows.column("vec_id").fill_null(NO_ID).to_numpy()
    for at, a, places, b in _sides(anchors, rows):
        for label in np.unique(a_label[at]):
            mine, theirs = np.flatnonzero(a_label[at] == label), np.flatnonzero(r_label[places] == label)
            for i, j, scores in _tiles(a[mine], b[theirs]):
                these = places[theirs[j:j + TILE[1]]]
                for n, line in enumerate(scores):
                    anchor = at[mine[i + n]]
                    other = r_row[these] != a_row[anchor]
                    k = np.flatnonzero(other)[_best(line[other], ids[these[other]], POSITIVES)]
                    new = list(zip((-line[k]).tolist(), ids[these[k]].tolist(), r_row[these[k]].tolist()))
                    heaps[anchor] = heapq.nsmallest(POSITIVES, heaps.get(anchor, []) + new)
    return [(a_row[n], a_id[n], a_label[n], row, None if i == NO_ID else i, -s) for n, h in heaps.items() for s, i, row in h]


def _negatives(anchors: pa.Table, rows: pa.Table) -> list[tuple]:
    heaps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    a_label, r_label = (t.column("label").to_numpy() for t in (anchors, rows))
    a_row, a_id = (anchors.column(c).to_numpy() for c in ("row", "vec_id"))
    ids, asked = rows.column("vec_id").fill_null(NO_ID).to_numpy(), anchors.column("positives").to_pylist()
    for at, a, places, b in _sides(anchors, rows):
        for i, j, scores in _tiles(a, b):
            these = places[j:j + TILE[1]]
            for n, line in enumerate(scores):
                anchor = at[i + n]
                tops = [p["score"] for p in asked[anchor]]
                fit = (r_label[these] != a_label[anchor]) & (line <= max(tops)) & (WINDOW[1] * line >= WINDOW[0] * min(tops))
                near = np.flatnonzero(fit)
                near = near[np.lexsort((ids[these[near]], -line[near]))]
                down = -line[near]
                for p, top in enumerate(tops):
                    first = np.searchsorted(down, -top)
                    k = near[first:first + NEGATIVES]
                    k = k[WINDOW[1] * line[k] >= WINDOW[0] * top]
                    if len(k):
                        new = list(zip((-line[k]).tolist(), ids[these[k]].tolist()))
                        heaps[anchor, p] = heapq.nsmallest(NEGATIVES, heaps.get((anchor, p), []) + new)
    return [(a_row[n], asked[n][p]["other_row"], a_id[n], asked[n][p]["other_id"], None if i == NO_ID else i, asked[n][p]["score"], -s)
            for (n, p), h in heaps.items() for s, i in h]


def mined(rows: DataFrame, anchors: Column, label: Column, component: Callable[[Column], Column]) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, embedding and what `label` needs; anchors: where a row is an anchor; component:
    the integer that a component becomes. Positives of an anchor are its POSITIVES best other rows of
    its label; for each the NEGATIVES best rows of other labels whose score is in its WINDOW. Higher
    scores come first, ties by smaller vec_id.

    Rows without a label or vector, with an empty vector, or with a component that is null or not
    finite take no part; vectors of other lengths have no product. Zero vectors score 0. Repeated
    rows are rows of their own. Rows with a null id are no anchors and come last of a tie. Windows
    without a row, anchors without a positive and empty tables give no rows. A product that might
    leave 64 bits is an error, as in Spark's own arithmetic. Other columns are ignored.
    """
    v = F.col("embedding")
    whole = F.size(v) > 0
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    held = numbered(rows.where(F.coalesce(label.isNotNull() & v.isNotNull() & whole & ~bad, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(v, component).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks")))
    asking, all_rows = held.where(F.col("asks") & F.col("vec_id").isNotNull()).drop("asks"), held.drop("asks")
    pairs = joined(asking, all_rows, _positives, PAIRS, GROUP, CHUNK)
    w = Window.partitionBy("anchor_row").orderBy(F.desc("score"), F.col("other_id").asc_nulls_last(), "other_row")
    best = pairs.withColumn("n", F.row_number().over(w)).where(F.col("n") <= POSITIVES)
    windows = best.groupBy(F.col("anchor_row").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("n", "other_row", "other_id", "score"))).alias("positives"))
    asked = stored(asking.join(windows, "row"))
    found = joined(asked, all_rows, _negatives, MINED, GROUP, CHUNK)
    w = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
