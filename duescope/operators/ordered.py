"""Running totals and exact order statistics without sorting a group in one task.

A window ordered over a whole group puts the group into one task. Here the value range is
cut into slices at approximate quantiles of the *distinct* values, so every (group, slice)
is a small fraction of all distinct values however skewed the groups are. Each slice is
summed up in order on its own and shifted by the totals of the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.storage import stored

SLICES = 64  # at least; a session with more shuffle partitions cuts as many slices
_ALL = "_all"


def _grouped(df: DataFrame, groups: list[str]) -> tuple[DataFrame, list[str]]:
    """A constant key stands in for "no groups"."""
    return (df, groups) if groups else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def running_totals(points: DataFrame, groups: list[str], order: str, sums: list[str],
                   slices: int | None = None) -> DataFrame:
    """Adds `cum_<name>`, the total of `name` over rows with order <= own, per group.

    `points` has one row per (groups, order); `order` is numeric or a date. It is read
    three times, so pass a stored table when it is expensive.
    """
    slices = slices or max(SLICES, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    extra = [] if groups else [_ALL]
    points, keys = _grouped(points, groups)
    cuts = points.agg(
        F.percentile_approx(order, [i / slices for i in range(1, slices)], 10000).alias("c")
    ).scalar()
    sliced = points.withColumn("_cuts", cuts).withColumn(
        "_slice", F.size(F.filter("_cuts", lambda c: c < F.col(order)))
    ).drop("_cuts")
    place = [*keys, "_slice"]

    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sliced.groupBy(*place).agg(*[F.sum(s).alias(s) for s in sums]).select(
        *place, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_shift_{s}") for s in sums]
    )
    within = Window.partitionBy(*place).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = sliced.withColumns({f"cum_{s}": F.sum(s).over(within) for s in sums})
    shifted = local.join(shifts, place).withColumns(
        {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_shift_{s}") for s in sums}
    )
    return shifted.drop("_slice", *extra, *[f"_shift_{s}" for s in sums])


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """One row per (groups, value) with its count `n`; nulls are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count("*").alias("n")
    )


def exact_quantiles(df: DataFrame, groups: list[str], value: str, wanted: dict[str, float],
                    slices: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles per group, one output column per entry of `wanted`."""
    keyed, keys = _grouped(df, groups)
    counts = stored(value_counts(keyed, keys, value))
    ranked = running_totals(counts, keys, value, ["n"], slices)
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("_size"))
    ranked = ranked.join(sizes, keys)

    def at(rank: Column) -> Column:
        here = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
        return F.max(F.when(here, F.col(value).cast("double")))

    aggregates, outputs = [F.max("_size").alias("_size")], {}
    for name, q in wanted.items():
        position = (F.col("_size") - 1) * F.lit(float(q))
        aggregates += [
            at(F.floor(position)).alias(f"_lo_{name}"), at(F.ceil(position)).alias(f"_hi_{name}")
        ]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outputs[name] = low + (high - low) * (position - F.floor(position))
    picked = ranked.groupBy(*keys).agg(*aggregates)
    return picked.select(*groups, *[c.alias(n) for n, c in outputs.items()])


def empirical_cdf(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Distinct values with the share of rows at or below them."""
    counts = stored(value_counts(df, groups, value))
    ranked = running_totals(counts, groups, value, ["n"])
    if not groups:
        size = counts.agg(F.sum("n")).scalar()
        return ranked.select(value, "n", (F.col("cum_n") / size).alias("cdf"))
    sizes = counts.groupBy(*groups).agg(F.sum("n").alias("_size"))
    return ranked.join(sizes, groups).select(
        *groups, value, "n", (F.col("cum_n") / F.col("_size")).alias("cdf")
    )


def date_at_quantile(df: DataFrame, date: str, q: float, groups: list[str] | None = None
                     ) -> DataFrame:
    """Row-weighted date quantile, lower interpolation: the first date whose cumulative row
    count exceeds floor((n - 1) * q). Works on the date histogram, one row per date."""
    groups = groups or []
    histogram, keys = _grouped(
        df.groupBy(*groups, date).agg(F.count("*").alias("n")), groups
    )
    by = Window.partitionBy(*keys)
    ranked = histogram.withColumns({
        "cum": F.sum("n").over(by.orderBy(date).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)),
        "size": F.sum("n").over(by),
    })
    past = F.col("cum") > F.floor((F.col("size") - 1) * F.lit(float(q)))
    return ranked.groupBy(*keys).agg(F.min(F.when(past, F.col(date))).alias("cut")).select(
        *groups, "cut"
    )
