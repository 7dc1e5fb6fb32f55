"""Ranked lexical search over hashed max-sketches.

Index, made of the documents alone: a document's terms are hashed to WIDTH coordinates, and each
coordinate keeps the largest impact of its terms. A term's impact grows with its occurrences, so
the largest number of occurrences is what is stored, block by block and by coordinate; document
and term totals, and the number of documents of each term, come from the same pass.

A query looks the coordinates of its terms up, weighs what it finds and adds it up: an upper bound
of the score of every document of a block, many queries at a time. Documents are then rescored
exactly, from their texts, in descending order of bounds, in waves that grow, until no bound left
reaches a query's present last place. Queries and blocks meet in the cells of a grid.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescope.llm.common import ascii_lower, letter_words, pieces, utf8
from duescope.llm.grid import Cell, joined
from duescope.storage import stored

WIDTH = 1 << 16  # coordinates of a sketch
BLOCK = 4 << 20  # bytes of documents in a block
TERMS, BLOCKS = 50_000, 8  # query terms and blocks of a cell, about
COUNTED, REMEMBERED = 200_000, 200_000  # terms a task counts before it hands them on; terms whose coordinates it keeps
TOP, WIDER = 50, 8  # documents of a query; how much a wave grows on the one before
NO_ID = (1 << 63) - 1  # stands for a null id and sorts it last
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between the words of a lower-cased text
INDEX = ("row long, doc_ids array<long>, k1 array<long>, k2 array<long>, n_words array<long>, coords array<int>, "
         "starts array<int>, places array<int>, most array<int>, term string, df long")
SKETCH = INDEX.split(", ")[:9]
BOUNDS = "query long, doc_id long, k1 long, k2 long, bound long"


class _Coordinates(dict):
    """Term (bytes) -> coordinate, remembered."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        at = self[term] = xxhash.xxh64_intdigest(term, 42) & (WIDTH - 1)
        return at


def _sketched(counts: list[Counter], coordinates: _Coordinates) -> tuple[np.ndarray, ...]:
    """Coordinates that occur, where each starts, and document and largest count of each entry."""
    coord = np.fromiter((coordinates[t] for c in counts for t in c), np.int64)
    most = np.fromiter((n for c in counts for n in c.values()), np.int64)
    doc = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    order = np.lexsort((doc, coord))
    coord, doc, most = coord[order], doc[order], most[order]
    if not len(coord):
        return coord, np.zeros(1, np.int64), doc, most
    first = np.flatnonzero(np.r_[True, (coord[1:] != coord[:-1]) | (doc[1:] != doc[:-1])])
    coord, doc, most = coord[first], doc[first], np.maximum.reduceat(most, first)
    starts = np.flatnonzero(np.r_[True, coord[1:] != coord[:-1]])
    return coord[starts], np.r_[starts, len(coord)], doc, most


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 128-bit key of both, in two halves."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"))


def index(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored index of `docs` (doc_id, text): blocks of sketches, and (term, df)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [c.split()[0] for c in INDEX.split(", ")], [f.type for f in _schema()]
        coordinates, df = _Coordinates(), Counter()

        def counted() -> pa.RecordBatch:
            empty = [pa.nulls(len(df), k) for k in kinds[:9]]
            terms = pa.array([t.decode("utf-8", "replace") for t in df], pa.string())
            return pa.RecordBatch.from_arrays([*empty, terms, pa.array(list(df.values()), pa.int64())], names)

        for b in pieces(batches, BLOCK):
            words = [letter_words(t) for t in utf8(b.column(1))]
            counts = [Counter(w) for w in words]
            ids = b.column(0).fill_null(NO_ID).to_numpy()
            lists = (ids, b.column(2).to_numpy(), b.column(3).to_numpy(), [len(w) for w in words], *_sketched(counts, coordinates))
            number = xxhash.xxh64_intdigest(lists[1].tobytes() + ids[:1].tobytes()) - (1 << 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip((number, *lists, None, None), kinds)], names)
            for c in counts:
                df.update(c.keys())
                if len(df) > COUNTED:
                    yield counted()
                    df.clear()
        yield counted()

    made = stored(keyed(docs).select("doc_id", "text", "k1", "k2").mapInArrow(run, INDEX))
    blocks = made.where("row IS NOT NULL").select(*[c.split()[0] for c in SKETCH])
    return blocks, made.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in INDEX.split(", "))])


def _bounder(documents: int, words: int, limit: int) -> Cell:
    """For each query of a cell the next `limit` documents in descending order of bounds: those
    behind its cursor that can still come before its last place."""
    def run(terms: pa.Table, blocks: pa.Table) -> list[tuple]:
        queries = _queries(terms)
        best: dict[int, list[np.ndarray]] = {}
        for row in range(blocks.num_rows):
            ids, k1, k2, n, coords, starts, places, most = (
                blocks.column(c.split()[0])[row].values.to_numpy().astype(np.int64) for c in SKETCH[1:])
            m = 50 + 50 * n * documents // max(words, 1)
            impact = 1_000_000_000 * most // (1_000 * most + 20 * m[places]) if len(most) else most
            for query, (coord, weight, cursor, last) in queries.items():
                at = np.searchsorted(coords, coord)
                there = np.flatnonzero(coords[np.minimum(at, len(coords) - 1)] == coord) if len(coords) else ()
                total = np.zeros(len(ids), np.int64)
                for t in there:
                    span = slice(starts[at[t]], starts[at[t] + 1])
                    total[places[span]] += weight[t] * impact[span]
                keep = np.flatnonzero(total > 0)
                b, i, h = total[keep], ids[keep], k1[keep]
                late = (b < cursor[0]) | (b == cursor[0]) & ((i > cursor[1]) | (i == cursor[1]) & (h > cursor[2]))
                keep = keep[late & ((b > last[0]) | (b == last[0]) & (i < last[1]))]
                new = np.stack([-total[keep], ids[keep], k1[keep], k2[keep]])
                rows = np.concatenate([best[query], new], axis=1) if query in best else new
                best[query] = rows[:, np.lexsort(rows[2::-1])[:limit]]
        return [(q, int(d), int(a), int(c), -int(b)) for q, rows in best.items() for b, d, a, c in rows.T]

    return run


def _queries(terms: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, tuple, tuple]]:
    row, coord, weight = (terms.column(c).to_numpy() for c in ("row", "coord", "w"))
    state = [terms.column(c).to_numpy() for c in ("c_bound", "c_id", "c_key", "l_score", "l_id")]
    order = np.argsort(row, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(row[order]) != 0])
    out = {}
    for lo, hi in zip(cut, np.r_[cut[1:], len(order)]):
        at = order[lo:hi]
        s = [int(x[at[0]]) for x in state]
        out[int(row[at[0]])] = (coord[at], weight[at], tuple(s[:3]), tuple(s[3:]))
    return out


def _words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), lambda w: w != "")


def _impact(tf: Column, n: Column, documents: int, words: int) -> Column:
    """The integer impact of a term that occurs `tf` times among `n` words."""
    m = F.call_function("div", F.lit(50).cast("long") * n * F.lit(documents), F.lit(max(words, 1)).cast("long")) + 50
    return F.call_function("div", F.lit(1_000_000_000).cast("long") * tf, F.lit(1_000).cast("long") * tf + F.lit(20).cast("long") * m)


def _rescored(pairs: DataFrame, docs: DataFrame, terms: DataFrame, documents: int, words: int) -> DataFrame:
    """query, doc_id, k1, score and copies (rows of `docs` like it) of the pairs with a score."""
    wanted = pairs.select("k1", "k2").distinct()
    texts = docs.join(wanted, ["k1", "k2"]).groupBy("k1", "k2").agg(
        F.first("text").alias("text"), F.count("*").alias("copies"))
    split = texts.select("k1", "k2", "copies", _words(F.col("text")).alias("words"))
    tf = (split.select("k1", "k2", "copies", F.size("words").cast("long").alias("n"), F.explode("words").alias("term"))
          .groupBy("k1", "k2", "term").agg(F.count("*").alias("tf"), F.first("n").alias("n"), F.first("copies").alias("copies")))
    asked = pairs.join(terms.select(F.col("row").alias("query"), "term", "w"), "query")
    part = F.col("w") * _impact(F.col("tf"), F.col("n"), documents, words)
    return (asked.join(tf, ["k1", "k2", "term"]).groupBy("query", "doc_id", "k1", "k2")
            .agg(F.sum(part).alias("score"), F.first("copies").alias("copies")).where("score > 0"))


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` documents of `docs` (doc_id, text) with the highest
    scores above 0 for each row of `items` (item_id, text); equal scores by ascending doc_id.

    Null and empty texts have no terms: such documents aren't counted or found, such items find
    nothing. Repeated documents are documents of their own and each takes a place. Items equal in id
    and text are one; other texts of an id are ranked by themselves. Null doc_ids come last of a tie.
    Fewer documents than `k` are all returned. Empty tables give an empty result. Other columns are
    ignored.
    """
    texts = keyed(docs)
    blocks, df = index(docs)
    documents, words = blocks.select(
        F.sum(F.size(F.filter("n_words", lambda n: n > 0)).cast("long")),
        F.sum(F.aggregate("n_words", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    documents, words, size = int(documents or 0), int(words or 0), blocks.count()
    asked = stored(items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
                   .select(F.monotonically_increasing_id().alias("row"), "*"))
    each = asked.select("row", F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    terms = stored(each.join(df, "term").select(
        "row", "term", F.xxhash64("term").bitwiseAND(F.lit(WIDTH - 1)).alias("coord"), weight.alias("w")))
    state = terms.select("row").distinct().select(
        "row", F.lit(NO_ID).alias("c_bound"), F.lit(-1).cast("long").alias("c_id"), F.lit(0).cast("long").alias("c_key"),
        F.lit(0).cast("long").alias("l_score"), F.lit(NO_ID).alias("l_id"))
    done: list[DataFrame] = []
    limit = k
    while True:
        found = joined(terms.drop("term").join(state, "row"), blocks, _bounder(documents, words, limit), BOUNDS, TERMS, BLOCKS, size)
        down = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id", "k1")
        wave = stored(found.withColumn("n", F.row_number().over(down)).where(F.col("n") <= limit))
        done.append(stored(_rescored(wave.select("query", "doc_id", "k1", "k2").distinct(), texts, terms, documents, words)))
        scores = reduce(DataFrame.unionByName, done)
        place = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id", "k1")
        best = scores.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k)
        last = best.where(F.col("n") == k).select(F.col("query").alias("row"), F.col("score").alias("l_score"), F.col("doc_id").alias("l_id"))
        reached = wave.where(F.col("n") == limit).select(
            F.col("query").alias("row"), F.col("bound").alias("c_bound"), F.col("doc_id").alias("c_id"), F.col("k1").alias("c_key"))
        state = stored(reached.join(last, "row", "left").select(
            "row", "c_bound", "c_id", "c_key", F.coalesce("l_score", F.lit(0)).alias("l_score"), F.coalesce("l_id", F.lit(NO_ID)).alias("l_id")))
        if state.isEmpty():
            break
        limit *= WIDER
    copied = best.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))).alias("copy"))
    place = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id", "k1", "copy")
    top = copied.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("query"), "item_id")
    return top.join(names, "query").select(
        "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
