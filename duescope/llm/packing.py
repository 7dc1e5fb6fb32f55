"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces. Pieces are dealt by hash into
shards of about SHARD pieces, whatever a document's key or source; each shard is packed on its
own, so shards are bounded, and what their last sequences waste is small against a shard.

Within a shard, longest pieces first: a piece goes into the open sequence it fits best. If it
fits none, a new one is opened. For each permitted length, the pieces that would best fill it up
are looked ahead for, and the length with the least cost per filled token is opened; the cost of a
length grows faster than the length (attention). In the end every sequence is cut down to the
smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.storage import stored

LENGTHS = (512, 1024, 2048, 4096)
SHARD = 16_384  # pieces in a shard, about
ATTENTION = 1 / 8192  # cost of a sequence of length n: n * (1 + ATTENTION * n)
END = 1  # tokens after each document
PACKED = "shard long, bin int, bin_size int, bin_used int, doc_id long, copy int, piece int, doc_start long, n_tokens int, bin_start int"


def cost(length: int, attention: float = ATTENTION) -> float:
    return length * (1 + attention * length)


class _Left:
    """Counts of the lengths not packed yet."""

    def __init__(self, lengths: Sequence[int]) -> None:
        values, counts = np.unique(np.asarray(lengths, np.int64), return_counts=True)
        self.lengths, self.counts = values.tolist(), dict(zip(values.tolist(), counts.tolist()))

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            del self.counts[n]
            del self.lengths[bisect_left(self.lengths, n)]

    def filled(self, room: int) -> int:
        """Tokens that would fill `room`, taking the longest piece that fits again and again."""
        used, below = 0, len(self.lengths)
        while room > used and (below := bisect_right(self.lengths, room - used, 0, below)):
            n = self.lengths[below - 1]
            if not n:
                break
            used += n * min(self.counts[n], (room - used) // n)
            below -= 1
        return used


def pack(lengths: Sequence[int], sizes: Sequence[int] = LENGTHS) -> list[tuple[int, int]]:
    """(bin, start in the bin) of each length; none may exceed the largest size."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    left, out = _Left(lengths), [(0, 0)] * len(lengths)
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    for i in order:
        n = lengths[i]
        left.take(n)
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            best = min((s for s in sizes if s >= n), key=lambda s: (cost(s) / max(1, n + left.filled(s - n)), -s))
            room, b = best, len(used)
            used.append(0)
        out[i] = (b, used[b])
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    return out


def downsized(used: int, sizes: Sequence[int] = LENGTHS) -> int:
    """The smallest permitted length that holds `used` tokens."""
    return min(s for s in sizes if s >= used)


def word_tokens(docs: DataFrame) -> DataFrame:
    """doc_id and n_tokens: words of the text and an end mark. Null text has no words."""
    words = F.size(F.filter(F.split(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return docs.select("doc_id", (words + END).cast("long").alias("n_tokens"))


def packed(tokens: DataFrame, sizes: Sequence[int] = LENGTHS, shard: int = SHARD) -> DataFrame:
    """One row per piece of the rows of `tokens` (doc_id, n_tokens): PACKED.

    A document's tokens doc_start to doc_start + n_tokens stand at bin_start of sequence
    (shard, bin), which has bin_size places and bin_used tokens. Null or negative token counts
    count as none; a document without tokens has one empty piece. `copy` numbers repeated rows
    of a doc_id, so that every row is packed. An empty table gives an empty result. Other columns
    are ignored.
    """
    sizes = sorted(sizes)
    largest = sizes[-1]
    n = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("long")
    # equal rows are numbered within their count, so no window over a hot id is needed
    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n")).groupBy("doc_id", "n").agg(F.count("*").alias("copies"))
    rows = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / largest) - 1).cast("int")
    cut = rows.select("doc_id", "n", "copy", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = (F.col("piece") * F.lit(largest)).cast("long")
    cut = stored(cut.select("doc_id", "copy", "piece", start.alias("doc_start"), F.least(F.lit(largest), F.col("n") - start).cast("int").alias("n_tokens")))
    shards = max(1, -(-cut.count() // shard))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], ignore_index=True)
        places = pack(pdf.n_tokens.tolist(), sizes)
        pdf["bin"], pdf["bin_start"] = [p[0] for p in places], [p[1] for p in places]
        pdf["bin_used"] = pdf.groupby("bin").n_tokens.transform("sum")
        pdf["bin_size"] = [downsized(u, sizes) for u in pdf.bin_used]
        pdf["doc_id"] = pdf.doc_id.astype("Int64")
        return pdf[["shard", "bin", "bin_size", "bin_used", "doc_id", "copy", "piece", "doc_start", "n_tokens", "bin_start"]]

    return dealt.groupBy("shard").applyInPandas(run, PACKED)
