"""Block joins: a stated query side against all rows, in cells of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from duescope.storage import stored


def numbered(df: DataFrame) -> DataFrame:
    """`df`, stored, with `row`: a number that no other row has, so that equal rows stay apart."""
    return stored(df.select(F.monotonically_increasing_id().alias("row"), "*"))


Cell = Callable[[pa.Table, pa.Table], list[tuple]]


def joined(left: DataFrame, right: DataFrame, fn: Cell, schema: str, left_per: int, right_per: int, right_weight: int | None = None) -> DataFrame:
    """What `fn` makes of the cells of a grid that hold rows of both sides, as rows of `schema`.

    `left` goes by a hash of `row` to groups of about `left_per` rows, each of them to all chunks
    of about `right_per` rows of `right` and the reverse, so a pair of rows meets in one cell and no
    value of either table makes a cell larger. There are at least as many chunks as shuffle
    partitions. `right_weight`: what to count `right` as instead of its rows.
    """
    least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.ceil(left.count() / left_per))
    chunks = max(least, math.ceil((right.count() if right_weight is None else right_weight) / right_per))

    def own(n: int, name: str):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(name)

    def every(n: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found = fn(a, b) if a.num_rows and b.num_rows else []
        columns = list(zip(*found)) or [()] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    a = left.select("*", own(groups, "g"), every(chunks, "c")).groupBy("g", "c")
    # new names for the columns of a table that may stand on both sides
    b = right.select(*[F.col(n).alias(n) for n in right.columns], own(chunks, "c"), every(groups, "g")).groupBy("g", "c")
    return a.cogroup(b).applyInArrow(run, schema)


def matrices(table: pa.Table, column: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of the lists in `column`: the places of its rows and their values as a matrix."""
    lists = table.column(column).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values, starts = lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
    return {int(d): (at := np.flatnonzero(sizes == d), values[starts[at][:, None] + np.arange(d)]) for d in np.unique(sizes)}
