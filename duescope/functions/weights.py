"""Training weights and the direction prior of a feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recency_weight(snapshot: Column, as_of: Column, half_life_days: float = 180.0) -> Column:
    """Halves with every `half_life_days` of age; dates after `as_of` weigh 1."""
    age = F.greatest(F.datediff(as_of, snapshot), F.lit(0))
    return F.pow(F.lit(0.5), age / F.lit(half_life_days))


def positive_weight(df: DataFrame, label: str = "target", multiplier: float = 1.0) -> Column:
    """negatives / positives * multiplier over `df`, as a scalar subquery."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    )
    return counts.select(
        F.col("neg") / F.greatest(F.col("pos"), F.lit(1)) * F.lit(float(multiplier))
    ).scalar()


def with_class_weight(df: DataFrame, label: str = "target", multiplier: float = 1.0,
                      name: str = "class_weight") -> DataFrame:
    weight = positive_weight(df, label, multiplier)
    return df.withColumn(name, F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))
