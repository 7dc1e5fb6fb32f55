"""Statistics of a whole text as Spark columns; no Python runs on the executors.

Arrays stay inside their row: nothing is exploded or shuffled, so a text costs memory in
proportion to its own length only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5
LONGS = "array<bigint>"


def spread_words(positions: Column, width: int) -> Column:
    """Words under windows of `width` that start at the sorted `positions`."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        positions, start,
        lambda a, p: F.struct((p + width).alias("end"), (a["n"] + p + width - F.greatest(a["end"], p)).alias("n")),
        lambda a: a["n"].cast("long"))


def removed(text: Column, pattern: str) -> Column:
    """Characters of `text` that match `pattern`."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def with_statistics(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """`keep` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, n_upper,
    n_lines, n_stops (sentence ends and commas) of `text`. Null text counts as empty, all zero."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    # each step is a projection of its own: a value that later steps use again is computed once
    words = docs.select(*keep, text).withColumn(
        "words", F.filter(F.split("text", f"{SPACE}+"), lambda w: w != ""))
    hashes = words.withColumns({
        "h": F.transform("words", lambda w: F.xxhash64(w)),
        "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))})
    windows = hashes.withColumn("windows", F.when(
        F.size("h") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW),
                    lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast(LONGS)))
    # few texts repeat any window; only theirs are sorted
    ordered = windows.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    repeats = ordered.withColumn("repeats", F.when(
        F.col("ordered").isNotNull(),
        F.array_sort(F.transform(F.filter(
            F.transform("ordered", lambda p, k: F.when(
                F.get("ordered", k - 1)["w"].eqNullSafe(p["w"]) | F.get("ordered", k + 1)["w"].eqNullSafe(p["w"]), p["i"])),
            lambda i: i.isNotNull()), lambda i: i))))
    out = {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": removed(F.col("text"), SYMBOLS),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(spread_words(F.col("repeats"), WINDOW), F.lit(0).cast("long")),
        "n_chars": F.length("text").cast("long"),
        "n_upper": removed(F.col("text"), "[A-Z]+"),
        "n_lines": F.size("lines").cast("long"),
        "n_stops": removed(F.col("text"), "[.,!?]+"),
    }
    kept = [c for c in repeats.columns if c not in ("text", "words", "h", "lines", "windows", "ordered", "repeats")]
    return repeats.select(*kept, *[c.alias(n) for n, c in out.items()])
