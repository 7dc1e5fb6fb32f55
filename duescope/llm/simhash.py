"""Near-duplicates by SimHash, found in the space of per-segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits. The bit counts of the segments
embed it as a point; the Manhattan distance of two points is never more than the number of
differing bits. The point is kept in unary (a segment's bits sorted), so that Manhattan
distance is the bit count of an exclusive or and everything stays in generated code.

Range join: points at distance 3 or less agree on at least 3 of 6 equal subspaces, so each
choice of 3 subspaces is a grid with cells of width one, and every such pair shares a cell of
one of the 20 grids. Pairs of a cell are kept if their Manhattan distance is 3 or less, then
verified on the fingerprints. Cells with many members (a large group of near copies) are dealt
anew over the 560 grids of 13 out of 16 subspaces instead of being paired whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.llm.common import components, pieces, utf8
from duescope.storage import stored

BITS, DISTANCE, SHINGLE, SEED = 64, 3, 3, 42
EVEN = 0x5555555555555555  # the lower bit of each segment
CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: bytes | None, words: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; without words zero."""
    w = text.lower().split() if text else []
    if not w:
        return 0
    shingles = [b" ".join(s) for s in zip(*(w[i:] for i in range(words)))] or [b" ".join(w)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), CHUNK):
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[at:at + CHUNK]], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp) for every row of `docs` (doc_id, text); null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fp = [fingerprint(t, words) for t in utf8(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "row_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedded(fp: Column) -> Column:
    """Bit counts 0, 1, 2 of the two-bit segments in unary: 00, 01, 11."""
    low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grids(subspaces: int, distance: int = DISTANCE) -> list[int]:
    """Masks of the embedding, one for each choice of subspaces that may have to agree."""
    edges = [round(i * BITS / 2 / subspaces) * 2 for i in range(subspaces + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(parts, subspaces - distance)]


def _cells(points: DataFrame, subspaces: int, distance: int) -> DataFrame:
    """(grid, cell, fp, point) of the cells that hold more than one point, with their size."""
    masks = F.array(*[F.col("point").bitwiseAND(F.lit(m)) for m in grids(subspaces, distance)])
    dealt = points.select("fp", "point", F.posexplode(masks).alias("grid", "cell"))
    sizes = dealt.groupBy("grid", "cell").agg(F.count("*").alias("members")).where("members > 1")
    return stored(dealt.join(sizes, ["grid", "cell"]))


def _pairs(cells: DataFrame, distance: int) -> DataFrame:
    a, b = cells.alias("a"), cells.alias("b")
    near = (
        a.join(b, (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell"))
               & (F.col("a.fp") < F.col("b.fp"))
               & (F.bit_count(F.col("a.point").bitwiseXOR(F.col("b.point"))) <= distance))
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    return near.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def links(fps: DataFrame, distance: int = DISTANCE, crowd: int = 128) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct fingerprints `fps.fp` at `distance` bits or less.

    `crowd`: cells with more members than this are dealt anew over finer grids. It shifts
    work, never results.
    """
    points = fps.select("fp", embedded(F.col("fp")).alias("point"))
    cells = _cells(points, 2 * distance, distance)
    crowded = cells.where(F.col("members") > crowd).select("fp", "point").distinct()
    fine = _cells(crowded, 5 * distance + 1, distance)
    return _pairs(cells.where(F.col("members") <= crowd), distance).unionByName(_pairs(fine, distance)).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, row_key, fp, root, component_id, links.

    root: the smallest fingerprint of the component; component_id: its smallest doc_id (null if
    all its ids are null); links: other fingerprints at `distance` or less. Equal texts share a
    fingerprint and so a component. Null and empty texts have fingerprint zero. Repeated rows
    stay repeated. An empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, words))
    each = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    pairs = stored(links(each, distance))
    member = components(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    rooted = stored(
        each.join(member, each.fp == member.node, "left").join(degree, "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stored(rooted.join(smallest, "root").select("fp", "root", "component_id", "links"))
    return rows.join(classes, "fp").select("doc_id", "row_key", "fp", "root", "component_id", "links")


def one_of_each(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """`docs` with one row of each component: that of the smallest doc_id (ids before null),
    among equal ids the one with the smallest hash of its text."""
    found = near_duplicates(docs, words, distance)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("w"))
    keep = first.select(F.col("w.row_key").alias("__kept"))
    copies = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    kept = copies.join(keep, copies["__key"] == keep["__kept"], "left_semi").dropDuplicates(["__key"])
    return kept.select(*[kept[c] for c in docs.columns])
