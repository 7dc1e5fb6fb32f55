"""Counts, distributions and sensitivity tables over a feature panel, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.functions import columns as C
from duescope.operators.evaluate import Grid, grid_counts
from duescope.operators.ordered import exact_quantiles


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def basic_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("snapshot_date").alias("snapshots"))


def condition_shares(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[
        F.avg(F.when(c, 1.0).otherwise(0.0)).alias(n) for n, c in conditions.items()])


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles, maximum."""
    value = F.col(column)
    base = df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"), F.min(value).alias("min"),
        F.max(value).alias("max"))
    quartiles = exact_quantiles(df, [], column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return base.withColumns({c: quartiles.select(c).scalar() for c in quartiles.columns})


def threshold_sensitivity(df: DataFrame, grid: Grid, ratio: str = "collection_ratio") -> DataFrame:
    """Per threshold: share of rows whose ratio is below it."""
    counts = grid_counts(df, grid, [], {"below": F.count("*")}, ratio, below=True)
    return counts.select("threshold", "below", (F.col("below") / F.col("all_below"))
                         .alias("share"))


def exposure_below(df: DataFrame, grid: Grid, ratio: str = "collection_ratio",
                   amount: str = "total_outstanding") -> DataFrame:
    """Per threshold: exposure of the rows whose ratio is below it, and its share."""
    sums = grid_counts(df, grid, [], {"exposure": F.sum(amount)}, ratio, below=True)
    return sums.select(
        "threshold", F.coalesce("exposure", F.lit(0.0)).alias("exposure"),
        (F.coalesce("exposure", F.lit(0.0)) / F.col("all_exposure")).alias("share"))


def per_snapshot(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(
        F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("high_risk"))


def histogram(df: DataFrame, column: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between the column's minimum and maximum; the last bin is closed."""
    span = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    at = (F.col(column) - F.col("_s.lo")) / (F.col("_s.hi") - F.col("_s.lo"))
    cell = F.least(F.floor(at * bins), F.lit(bins - 1)).cast("int")
    rows = df.filter(F.col(column).isNotNull()).withColumn("_s", span)
    return rows.groupBy(*(by or []), F.coalesce(cell, F.lit(0)).alias("bin")).agg(
        F.count("*").alias("n"))


def correlation_pairs(df: DataFrame, columns: list[str], top: int = 25) -> DataFrame:
    """Pearson correlation of the `top` columns with the largest variance, long form.

    One row of variances decides the columns; one aggregation computes all pairs, each over the
    rows where both values are present. Only column-count-sized results reach the driver.
    """
    variances = df.agg(*[F.var_samp(c).alias(c) for c in columns]).first().asDict()
    ranked = sorted(columns, key=lambda c: (-(variances[c] or 0.0), c))[:top]
    ordered = [(a, b) for i, a in enumerate(ranked) for b in ranked[i:]]
    row = df.agg(*[C.correlation(F.col(a), F.col(b)).alias(f"c{k}") for k, (a, b) in enumerate(ordered)])
    both_ways = [F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(f"c{k}").alias("corr"))
                 for k, (a, b) in enumerate(ordered) for x, y in dict.fromkeys([(a, b), (b, a)])]
    return row.select(F.explode(F.array(*both_ways)).alias("p")).select("p.*")


def missing_shares(df: DataFrame) -> DataFrame:
    """Columns with nulls and the share of rows that miss them, largest first."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    long = shares.unpivot([], df.columns, "column", "share")
    return long.filter(F.col("share") > 0).orderBy(F.desc("share"), "column")


def outcome_by_class(df: DataFrame, group: str, outcome: str = "collection_ratio") -> DataFrame:
    """Mean and exact quartiles of an outcome per predicted class or band."""
    means = df.groupBy(group).agg(F.count("*").alias("n"), F.avg(outcome).alias("mean"))
    quartiles = exact_quantiles(df, [group], outcome, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return means.join(quartiles, group, "left")


def label_checks(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("collection_ratio") > 1).alias("over_collected"),
        F.count_if(F.col("target").isNull()).alias("missing_label"))


def score_checks(scored: DataFrame, source: DataFrame, score: str = "score") -> DataFrame:
    """Scores outside [0, 1] or missing, and whether every input row was scored."""
    inside = F.coalesce(F.col(score).between(0, 1), F.lit(False))
    return scored.agg(
        F.count("*").alias("scored_rows"), F.count_if(~inside).alias("bad_scores"),
    ).withColumn("input_rows", source.agg(F.count("*")).scalar()).withColumn(
        "complete", (F.col("scored_rows") == F.col("input_rows")).cast("int"))
