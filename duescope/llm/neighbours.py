"""Nearest neighbours of stated queries by a block matrix join on int8 codes.

Queries and rows are dealt over a grid of cells. In a cell vectors become int8 codes with a scale of
their own; a tile of inner products of codes is one matrix product (exact: the sums stay below
2^24, where single precision counts every integer). With the lengths of what rounding left over,
it bounds each distance from both sides. A pair survives if its lower bound is no more than the
k-th smallest upper bound of its query, or than the worst of the query's heap once that is full.
Survivors are recomputed from the original vectors in double precision and merged into the heap.
The heaps of a query's cells meet in a rank limit that Spark applies before and after its shuffle.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescope.llm.grid import Cell, joined, matrices, numbered

GROUP, CHUNK = 16_384, 16_384  # queries and rows of a cell, about
TILE = (256, 2_048)  # queries and rows of a tile
EXACT = 1_024  # dimensions whose code products single precision adds without error
SLACK = 1e-12  # relative; covers rounding of bounds and of distances
NO_ID = (1 << 63) - 1  # sorts a null id behind the others
FOUND = "query_row long, query_id long, vec_id long, score double"


def usable(v: Column) -> Column:
    """Not null, not zero, and nothing in it null or not finite."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the rows of `x`, their scales, and bounds of the lengths of what is left over."""
    scale = np.maximum(np.abs(x).max(axis=1) / 127, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    rest = x - codes * scale[:, None]
    return codes, scale, np.sqrt((rest * rest).sum(axis=1)) * (1 + SLACK)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of int8 codes, exact."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        total += a[:, at:at + EXACT].astype(np.float32) @ b[:, at:at + EXACT].astype(np.float32).T
    return total


def bounds(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of all pairs of encoded rows."""
    (ca, sa, ea), (cb, sb, eb) = a, b
    na = (ca.astype(np.int64) ** 2).sum(axis=1) * sa * sa
    nb = (cb.astype(np.int64) ** 2).sum(axis=1) * sb * sb
    both = na[:, None] + nb[None, :]
    square, off = both - 2 * sa[:, None] * sb[None, :] * products(ca, cb), both * 1e-14
    error = ea[:, None] + eb[None, :]
    with np.errstate(invalid="ignore", over="ignore"):
        low = np.maximum(np.sqrt(np.maximum(square - off, 0)) - error, 0) * (1 - SLACK)
        high = (np.sqrt(np.maximum(square + off, 0)) + error) * (1 + SLACK)
    return np.where(np.isfinite(low), low, 0), np.where(np.isfinite(high), high, np.inf)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the columns of `a` and `b`, components added in their order."""
    total = np.zeros(a.shape[1])
    for x, y in zip(a, b):
        d = x - y
        total += d * d
    return np.sqrt(total)


def _searched(heaps: list[list], q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, x_rows: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Merge the rows of one chunk into the heaps of one group's queries."""
    for at in range(0, len(x), TILE[1]):
        part, rows = x[at:at + TILE[1]], x_rows[at:at + TILE[1]]
        code, turned = encoded(part), np.ascontiguousarray(part.T)
        for start in range(0, len(q), TILE[0]):
            mine = q[start:start + TILE[0]]
            low, high = bounds(encoded(mine), code)
            own = q_rows[start:start + TILE[0], None] == rows[None, :]
            low[own], high[own] = np.inf, np.inf
            worst = np.array([h[-1][0] if len(h) == k else np.inf for h in heaps[start:start + len(mine)]])
            if len(part) > k:
                worst = np.minimum(worst, np.partition(high, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero((low <= worst[:, None]) & ~own)
            found = distances(mine.T[:, i], turned[:, j])
            cut = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
            for lo, hi in zip(cut, np.r_[cut[1:], len(i)]):
                n = start + i[lo]
                heaps[n] = heapq.nsmallest(k, heaps[n] + list(zip(found[lo:hi].tolist(), ids[at + j[lo:hi]].tolist())))


def _searcher(k: int) -> Cell:
    def run(queries: pa.Table, rows: pa.Table) -> list[tuple]:
        out: list[tuple] = []
        q_row, x_row, q_id = queries.column("row").to_numpy(), rows.column("row").to_numpy(), queries.column("vec_id").to_numpy()
        x_id = rows.column("vec_id").fill_null(NO_ID).to_numpy()
        there = matrices(rows, "v")
        for d, (at, q) in matrices(queries, "v").items():
            if d not in there:
                continue
            places, x = there[d]
            heaps: list[list] = [[] for _ in at]
            _searched(heaps, q.astype(np.float64), q_row[at], x.astype(np.float64), x_row[places], x_id[places], k)
            out += [(q_row[n], q_id[n], None if i == NO_ID else i, s) for n, h in zip(at, heaps) for s, i in h]
        return out

    return run


def nearest(rows: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` rows of `rows` (vec_id, embedding) nearest to each row
    where `queries` holds, itself left out, by Euclidean distance; ties by smaller vec_id.

    Vectors that are null, empty, zero or hold something null or not finite take no part. A pair of
    different lengths has no distance. Repeated rows are rows of their own: each is found, and each
    is a query if its id is. Rows with a null id can be found (last of a tie) but aren't queries.
    Fewer rows than `k` are all found. An empty table gives an empty result. Other columns are ignored.
    """
    held = numbered(rows.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")))
    asking = held.where(F.col("asks") & F.col("vec_id").isNotNull()).drop("asks")
    found = joined(asking, held.drop("asks"), _searcher(k), FOUND, GROUP, CHUNK)
    w = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
