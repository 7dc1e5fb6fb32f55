"""What several operators share: reading tables, words, folds and components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duescope.storage import stored

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: all others become spaces.
LETTERS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letter_words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased. Null: none."""
    return text.translate(LETTERS).split() if text else []


def utf8(column: pa.Array) -> list[bytes | None]:
    """An Arrow string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], weight: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `weight` bytes or one row."""
    for b in batches:
        rows = max(1, int(b.num_rows * weight / max(1, b.nbytes)))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 0 by division by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def row_key(df: DataFrame, columns: list[str]) -> Column:
    """A hash of a row's columns; rows that agree in all of them get the same verdicts anyway."""
    return F.xxhash64(*[df[c] for c in columns])


def without(docs: DataFrame, rejected: DataFrame, key: Column) -> DataFrame:
    """The rows of `docs` whose `key` isn't in `rejected.row_key`, with the columns of `docs`."""
    bad = rejected.select(F.col("row_key").alias("__rejected")).distinct()
    return docs.join(bad, key == F.col("__rejected"), "left_anti")


def components(links: DataFrame) -> DataFrame:
    """Connected components of `links` (a, b: long) as (node, root), root the smallest node.

    Alternates two star steps, each a minimum per node and a join back, until the links no
    longer change: about log(longest path) rounds, and never more rows than links. Every
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    flat = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = flat.unionByName(flat.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("u"), F.least("a", "b").alias("m"))
        large = (both.join(least, both.a == least.u).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        lower = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(lower, large.a == lower.u)
        flat = stored(
            small.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lower.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        now = flat.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return flat.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        flat.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
