"""Benchmark passages in training text, found through a positional inverted index.

The index is sharded by document: a block holds some megabytes of documents, and for each term
of the test set one row with its postings (document, position) in that block. It is written to
the shared folder. A block is matched on its own: for each window of a test item the postings of
its rarest term are shifted by the term's offset and then intersected with the shifted postings
of the next rarest, until none or the exact phrase is left. With `slop`, each term may stand up
to that many words from its place (proximity match).

The test set goes to the tasks in slices of at most SLICE words, so what is broadcast is bounded;
each slice is matched against all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.llm.common import letter_words, pieces, row_key, utf8, without
from duescope.storage import stored

WINDOW = 10
SLICE = 1_000_000  # words of test items that are sent to the tasks at once
BLOCK = 8 << 20  # bytes of documents in a block of the index
INDEX = ("block long, term int, n int, docs array<int>, positions array<int>, "
         "doc_ids array<long>, row_keys array<long>")
NO_ID = -(1 << 63)  # stands for a null document id inside the index
FOUND = "doc_id long, row_key long, n_words long, matches array<struct<item_id:long,first:int,last:int>>"


class TestSet:
    """Windows of test items as term numbers, grouped by their length."""

    __test__ = False

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW) -> None:
        self.terms: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        self.items = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            ids = [self.terms.setdefault(w, len(self.terms)) for w in letter_words(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1) if size else ():
                by_length.setdefault(size, []).append((k, ids[at:at + size]))
        self.windows = [
            (size, np.array([k for k, _ in rows], np.int64), np.array([ids for _, ids in rows], np.int64))
            for size, rows in sorted(by_length.items())]


def _postings(test: TestSet, batch: pa.RecordBatch, block: int) -> pa.RecordBatch:
    get, docs, places, terms, lengths = test.terms.get, [], [], [], []
    for k, text in enumerate(utf8(batch.column(2))):
        words = letter_words(text)
        lengths.append(len(words))
        ids = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(ids >= 0)
        terms.append(ids[at])
        places.append(at.astype(np.int32))
        docs.append(np.full(len(at), k, np.int32))
    term, doc, place = np.concatenate(terms), np.concatenate(docs), np.concatenate(places)
    order = np.argsort(term, kind="stable")
    term, doc, place = term[order], doc[order], place[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    offsets = np.r_[0, 0, starts[1:], len(term)] if len(term) else np.zeros(2, np.int64)
    names, counts = np.r_[-1, term[starts]], np.r_[batch.num_rows, np.diff(np.r_[starts, len(term)])]
    # the row of term -1 describes the documents of the block; its "positions" are their lengths
    offsets = np.r_[0, offsets[1:] + batch.num_rows].astype(np.int32)
    first = np.arange(batch.num_rows, dtype=np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(v).astype(np.int32)))
             for v in ((first, doc), (np.array(lengths, np.int32), place))]
    once = [pa.array([c.to_pylist()] + [None] * (len(names) - 1), pa.list_(pa.int64())) for c in (batch.column(0), batch.column(1))]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(names), block, np.int64)), pa.array(names.astype(np.int32)),
         pa.array(counts.astype(np.int32)), *lists, *once],
        ["block", "term", "n", "docs", "positions", "doc_ids", "row_keys"])


def index(docs: DataFrame, test: TestSet) -> DataFrame:
    """The stored index of `docs` (doc_id, text) over the terms of the test set (`INDEX`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(pieces(batches, BLOCK)):
            yield _postings(test, b, (part << 32) + n)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), row_key(docs, ["doc_id", "text"]).alias("row_key"), "text")
    return stored(rows.mapInArrow(run, INDEX))


def _within(starts: np.ndarray, postings: np.ndarray, slop: int) -> np.ndarray:
    """Which of the sorted `starts` have a posting at most `slop` away."""
    at = np.searchsorted(postings, starts - slop)
    found = postings[np.minimum(at, len(postings) - 1)]
    return (at < len(postings)) & (np.abs(found - starts) <= slop)


def _spans(test: TestSet, lists: dict[int, np.ndarray], slop: int) -> tuple[np.ndarray, ...]:
    """(item, document << 32 | first word, length) of each window that occurs."""
    counts = np.zeros(len(test.terms) + 1, np.int64)
    counts[list(lists)] = [len(v) for v in lists.values()]
    items, starts, sizes = [], [], []
    for size, owner, ids in test.windows:
        for k in np.flatnonzero((counts[ids] > 0).all(axis=1)):
            window = ids[k]
            rarest = np.argsort(counts[window], kind="stable")
            left = lists[window[rarest[0]]] - rarest[0]
            for o in rarest[1:]:
                left = left[_within(left + o, lists[window[o]], slop)]
                if not len(left):
                    break
            if len(left):
                items.append(np.full(len(left), owner[k]))
                starts.append(left)
                sizes.append(np.full(len(left), size))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (items, starts, sizes))


def _matches(test: TestSet, block: pd.DataFrame, slop: int) -> pd.DataFrame:
    about = block[block.term < 0].iloc[0]
    lists = {int(t): (d.astype(np.int64) << 32) + p for t, d, p in zip(block.term, block.docs, block.positions) if t >= 0}
    item, start, size = _spans(test, lists, slop)
    order = np.lexsort((start, item))
    found: list[list[dict]] = [[] for _ in about.doc_ids]
    for k, s, n in zip(item[order].tolist(), start[order].tolist(), size[order].tolist()):
        doc, first = s >> 32, s & 0xFFFFFFFF
        mine, last = found[doc], first + n - 1
        if mine and mine[-1]["item_id"] == test.items[k] and mine[-1]["last"] >= first - 1:
            mine[-1]["last"] = max(mine[-1]["last"], last)
        else:
            mine.append({"item_id": test.items[k], "first": first, "last": last})
    return pd.DataFrame({
        "doc_id": about.doc_ids, "row_key": about.row_keys, "n_words": np.asarray(about.positions, np.int64), "matches": found})


def _matcher(test: TestSet, slop: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda block: _matches(test, block, slop)


def _slices(items: DataFrame) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """Test items in groups of about SLICE words, streamed through the driver group by group."""
    group, words = [], 0
    ordered = items.select(F.col("item_id").cast("long"), F.col("text")).orderBy("item_id", "text")
    for row in ordered.toLocalIterator():
        text = None if row.text is None else row.text.encode()
        n = len(letter_words(text))
        if group and words + n > SLICE:
            yield group
            group, words = [], 0
        group.append((row.item_id, text))
        words += n
    yield group


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """For every row of `docs` (doc_id, text): doc_id, row_key, n_words and `matches`.

    matches: (item_id, first, last), the words of the document under windows of the item; windows
    that touch are merged. Null and empty texts have no words and no matches; items without
    words have no windows; shorter items are one window. Repeated documents and items each count.
    Empty tables give an empty result or no matches. Other columns are ignored.
    """
    total: DataFrame | None = None
    for group in _slices(items):
        test = TestSet(group, window)
        found = index(docs, test).groupBy("block").applyInPandas(_matcher(test, slop), FOUND)
        found = found.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
        if total is None:
            total = found
        else:  # equal row keys have equal texts, so any one of them serves
            more = found.where(F.size("matches") > 0).select("row_key", F.col("matches").alias("more")).dropDuplicates(["row_key"])
            total = total.join(more, "row_key", "left").select(
                "doc_id", "row_key", "n_words",
                F.concat("matches", F.coalesce("more", F.array().cast("array<struct<item_id:long,first:int,last:int>>"))).alias("matches"))
    return total


def hit_words(matches: Column) -> Column:
    """Number of words under any of the matches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["first"].alias("first"), m["last"].alias("last"))))
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["last"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, a["end"]))).alias("n")),
        lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, item_ids (distinct, as strings, sorted) for every row."""
    found = phrase_matches(docs, items, window)
    ids = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    return found.select("doc_id", "row_key", "n_words", hit_words(F.col("matches")).alias("n_hit"), ids.alias("item_ids"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the documents that hold a window of a test item."""
    bad = contamination(docs, items, window).where("n_hit > 0")
    return without(docs, bad, row_key(docs, ["doc_id", "text"]))
