"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are range-partitioned and sorted by id, so each file holds one range of ids, each
stripe a part of it, and the stripes' and row groups' statistics prune reads by id; the Bloom
filters prune point lookups. Every row keeps its file's number and how many ids precede it in
the file, so global starts need one small sum per file.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duescope.llm.common import pieces

END = 0  # the id after each document
ROWS = 1_000  # documents that go to a Python worker at once
CACHE = 400_000  # words whose ids a task remembers; beyond it, it starts afresh


class Odd(Exception):
    """A text whose words can't be encoded one by one."""


class Words(dict):
    """Ids of words, remembered; those of the last two rounds of CACHE words stay.

    A key is what stands between spaces: a word that follows a space, or a line end and the word
    after it. A Latin word and the punctuation behind it are two tokens of the vocabulary's
    pattern; each goes straight to the library's merges. Other words go to the library whole.
    """

    PLAIN = re.compile(r"(\n?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?]*)")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in (32, *range(0xC0, 0x100))}
        self.space = self.letters[32]
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.marks: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.line_end = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.old = self.copy()
            self.clear()
        ids = self.old.get(word)
        if ids is None and word.isascii() and word.isalpha():
            ids = packed([t.id for t in self.merges(self.space + word)])
        elif ids is None:
            m = self.PLAIN.fullmatch(word)
            if m is None:
                first = word[:1] == "\n"
                if word.split() != [word[first:]]:
                    raise Odd
                ids = self.line_end + self.whole(word[1:]) if first else self.whole(" " + word)
            elif m[2]:
                if m[2] not in self.marks:
                    self.marks[m[2]] = self.whole(m[2])
                ids = self[m[1]] + self.marks[m[2]]
            else:
                seen = word if word.isascii() else word.translate(self.letters)
                ids = (self.line_end + packed([t.id for t in self.merges(seen[1:])]) if word[0] == "\n"
                       else packed([t.id for t in self.merges(self.space + seen)]))
        self[word] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Ids of whole texts as bytes of little-endian 32-bit integers.

    The vocabulary's pattern never joins what stands on two sides of a single space or line
    end between words, so words are encoded once (with their leading space) and remembered.
    Texts with any other white space go to the library whole.
    """

    def __init__(self, path: str) -> None:
        self.words = Words(path)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The encoder of this Python worker; kept with the library, for the worker's later tasks."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import tokenizers

        gc.disable()  # nothing here makes cycles, and collections walk all that is remembered

        kept = tokenizers.__dict__.setdefault("_encoders_by_path", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:  # the line end put before the first word is taken off again
            return b"".join(map(self.words.__getitem__, f"\n{text}".replace("\n", " \n")[1:].split(" ")))[len(self.words.line_end):]
        except Odd:
            return self.words.whole(text)


def write(docs: DataFrame, tokenizer: str, path: str, end: int = END, row_group: int = 1000) -> None:
    """Write `docs` (doc_id, text) as token ids in ascending doc_id order.

    tokenizer: path of a tokenizers file that every executor can read. Null and empty texts have
    the end id alone. Repeated ids stay repeated, next to each other; null ids come first. Other
    columns are ignored; an empty table gives a file set without rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, stop = Encoder.of(tokenizer), 0, np.array([end], "<u4").tobytes()
        for b in pieces(batches, 1 << 20):
            each = [encoder.encode(text) + stop for text in b.column(2).to_pylist()]
            ends = np.cumsum([len(x) // 4 for x in each])
            starts = np.r_[0, ends[:-1]]
            values = pa.array(np.frombuffer(b"".join(each), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(before + starts, pa.int64()), pa.array(ends - starts, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values)],
                ["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(ends[-1])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = rows.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(
        run, "doc_id long, part int, before long, n_tokens int, ids array<int>")
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
               "orc.row.index.stride": str(row_group), "compression": "lz4"}
    with _batches(docs.sparkSession, ROWS):
        made.write.options(**options).orc(path)


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it holds, Arrow batches have at most `rows` rows: a batch of long texts stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, before, n_tokens, ids. Filters on doc_id reach the stripes' metadata."""
    return spark.read.schema("doc_id long, part int, before long, n_tokens int, ids array<int>").orc(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all from the files."""
    files = read(spark, path)
    sums = files.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("n"))  # doesn't read the ids
    starts = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            at, flat = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<u4").tobytes())
            crc = [zlib.crc32(flat[4 * i:4 * j]) for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "part", "before", "n_tokens", "ids_crc32"])

    rows = files.select("doc_id", "part", "before", "ids").mapInArrow(
        run, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
