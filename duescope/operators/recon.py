"""Comparing two versions of a table, and following customers through the gates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duescope.functions.columns import strip_zeros
from duescope.storage import stored


def one_slice(df: DataFrame, snapshot: dt.date, country: str) -> DataFrame:
    return df.filter((F.col("snapshot_date") == snapshot) & (F.col("country") == country))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def shared_numeric(old: DataFrame, new: DataFrame) -> list[str]:
    return sorted(set(numeric_columns(old)) & set(numeric_columns(new)))


def _stats(df: DataFrame, columns: list[str], value: str) -> DataFrame:
    """(column, stat, value) from one aggregation."""
    stats = {}
    for c in columns:
        number = F.col(c).cast("double")
        stats |= {(c, "sum"): F.sum(number), (c, "mean"): F.avg(number),
                  (c, "nulls"): F.count_if(F.col(c).isNull()).cast("double")}
    row = df.agg(*[v.alias(f"{c}__{s}") for (c, s), v in stats.items()])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"),
                 F.col(f"{c}__{s}").alias(value)) for c, s in stats])
    return row.select(F.inline(entries))


def compare_stats(old: DataFrame, new: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Sum, mean and nulls of every shared numeric column; a zero base counts as 1e-9."""
    columns = shared_numeric(old, new)
    both = _stats(old, columns, "old_value").join(
        _stats(new, columns, "new_value"), ["column", "stat"])
    gap = F.abs(F.col("new_value") - F.col("old_value"))
    base = F.abs(F.col("old_value"))
    return both.withColumn("abs_diff", gap).withColumn(
        "pct_diff", F.col("abs_diff") / F.when(base == 0, 1e-9).otherwise(base)
    ).withColumn("matches", F.coalesce(F.col("pct_diff") <= tolerance, F.lit(False)).cast("int"))


def verdict(comparison: DataFrame) -> DataFrame:
    share = F.col("matched") / F.col("metrics") * 100
    return comparison.agg(
        F.count("*").alias("metrics"), F.sum("matches").alias("matched")
    ).withColumn("match_pct", share).withColumn(
        "verdict", F.when(share >= 99, "equivalent").when(share >= 95, "drift")
        .otherwise("different"))


def row_deltas(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """old - new per key, for the columns both sides have."""
    both = set(old.columns) & set(new.columns)
    shown = [c for c in columns if c in both]
    joined = old.alias("o").join(new.alias("n"), keys, "inner")
    return joined.select(*keys, *[
        (F.col(f"o.{c}").cast("double") - F.col(f"n.{c}").cast("double")).alias(f"{c}_delta")
        for c in shown])


BUCKETS = 1024  # of keys; a table of that many rows is what tells two versions apart


def _hashed(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    values = [F.col(c).cast("double") if c in numeric_columns(df) else F.col(c).cast("string") for c in columns]
    told = [*keys, *[F.coalesce(v.cast("string"), F.lit("")) for v in values], *[v.isNull() for v in values]]
    return df.select("*", F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"),
                     F.xxhash64(*told).alias("_h1"), F.xxhash64(F.lit(1), *told).alias("_h2"))


def digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, n, s1, s2): rows and sums of two row hashes for each bucket of keys. It takes one
    pass and sums before it shuffles, whatever the keys; the order of rows doesn't matter."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return _hashed(df, keys, columns, buckets).groupBy("_bucket").agg(F.count("*").alias("n"), total("_h1").alias("s1"), total("_h2").alias("s2"))


def differing_buckets(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The buckets of keys in which two versions of a table aren't the same rows."""
    a = digests(old, keys, columns, buckets)
    b = digests(new, keys, columns, buckets).select("_bucket", *[F.col(c).alias(f"new_{c}") for c in ("n", "s1", "s2")])
    same = F.col("n").eqNullSafe(F.col("new_n")) & F.col("s1").eqNullSafe(F.col("new_s1")) & F.col("s2").eqNullSafe(F.col("new_s2"))
    return a.join(b, "_bucket", "full").where(~same).select("_bucket")


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, change, <column>_delta) of the rows that differ: `changed` with old - new of each
    numeric column, or rows that only `old` or only `new` has.

    Only rows of buckets whose digests differ are moved and joined, so equal tables join nothing.
    Keys are unique and not null; null is equal to null.
    """
    both = sorted({*old.columns} & {*new.columns} & {*columns}, key=columns.index)
    apart = stored(differing_buckets(old, new, keys, both, buckets))

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = _hashed(df, keys, both, buckets).join(apart, "_bucket", "left_semi")
        return rows.select(*keys, F.struct("_h1", "_h2", *both).alias(name))

    joined = side(old, "o").join(side(new, "n"), keys, "full")
    o, n = F.col("o"), F.col("n")
    change = F.when(n.isNull(), "old").when(o.isNull(), "new").otherwise("changed")
    numbers = [c for c in both if c in shared_numeric(old, new)]
    return joined.where(o.isNull() | n.isNull() | (o["_h1"] != n["_h1"]) | (o["_h2"] != n["_h2"])).select(
        *keys, change.alias("change"), *[(o[c].cast("double") - n[c].cast("double")).alias(f"{c}_delta") for c in numbers])


def delta_summary(deltas: DataFrame, threshold: float = 0.01) -> DataFrame:
    """(column, average delta, largest absolute delta, rows beyond the threshold)."""
    names = [c for c in deltas.columns if c.endswith("_delta")]
    aggregates = []
    for c in names:
        aggregates += [
            F.avg(c).alias(f"{c}__avg"), F.max(F.abs(c)).alias(f"{c}__max"),
            F.count_if(F.abs(c) > threshold).alias(f"{c}__rows")]
    entries = F.array(*[
        F.struct(F.lit(c.removesuffix("_delta")).alias("column"),
                 F.col(f"{c}__avg").alias("avg_delta"),
                 F.col(f"{c}__max").alias("max_abs_delta"),
                 F.col(f"{c}__rows").alias("rows_beyond")) for c in names])
    return deltas.agg(*aggregates).select(F.inline(entries))


def largest_deltas(deltas: DataFrame, column: str, keys: list[str], limit: int = 20) -> DataFrame:
    return deltas.orderBy(F.abs(column).desc(), *keys).limit(limit)


def key_differences(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys on one side only, tagged with the side."""
    a, b = old.select(*keys), new.select(*keys)
    return a.subtract(b).withColumn("only_in", F.lit("old")).unionByName(
        b.subtract(a).withColumn("only_in", F.lit("new")))


def worst_first(df: DataFrame, by: str, keys: list[str], limit: int = 20) -> DataFrame:
    return df.orderBy(F.desc(by), *keys).limit(limit)


def stable_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Hash-bucket sample: the same rows whatever the partitioning."""
    return df.filter(F.pmod(F.xxhash64(key), F.lit(100)) < percent)


def numbered_sample(df: DataFrame, number: Column, percent: int) -> DataFrame:
    """The same by integer arithmetic on a whole number that tells rows apart, which any engine can
    repeat. Null numbers are left out."""
    spread = F.pmod(F.pmod(number, F.lit(1_000_003)) * 48_271, F.lit(2_147_483_647))
    return df.filter(F.pmod(spread, F.lit(100)) < percent)


def union_results(parts: list[DataFrame]) -> DataFrame:
    """Union by name of per-country results; a column missing in one part is null there."""
    if not parts:
        raise ValueError("no results to combine")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def funnel(gates: dict[str, DataFrame]) -> DataFrame:
    """Distinct customers at each gate, in one aggregation over the labelled union."""
    tagged = [
        df.select(F.lit(i).alias("step"), F.lit(name).alias("gate"), "customer_id")
        for i, (name, df) in enumerate(gates.items())]
    return union_results(tagged).groupBy("step", "gate").agg(
        F.count_distinct("customer_id").alias("customers"))


def coverage_hole(raw_items: DataFrame, covered: DataFrame) -> DataFrame:
    """Raw items of customers the view does not know under the exact id, by company code and
    year: items, amount, customers, and customers known once leading zeros are ignored."""
    missing = raw_items.join(covered.select("customer_id").distinct(), "customer_id", "left_anti")
    bare = covered.select(strip_zeros(F.col("customer_id")).alias("_bare")).distinct().withColumn(
        "_known", F.lit(1))
    return (
        missing.withColumn("_bare", strip_zeros(F.col("customer_id")))
        .join(bare, "_bare", "left")
        .groupBy("company_code", F.year("baseline_date").alias("year")).agg(
            F.count("*").alias("items"), F.sum("invoice_amount").alias("amount"),
            F.count_distinct("customer_id").alias("customers"),
            F.count_distinct(F.when(F.col("_known") == 1, F.col("customer_id")))
            .alias("known_when_stripped")))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))
