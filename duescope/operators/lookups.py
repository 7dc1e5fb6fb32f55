"""Joins against dimensions and lists. Spark broadcasts a side only when it is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_master(df: DataFrame, master: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Country and region from the customer master, then an optional country filter."""
    out = df.join(master, "customer_id", "left")
    if not countries:
        return out
    return out.filter(F.col("country").isin([c.upper() for c in countries]))


def eligible(df: DataFrame, items: DataFrame, countries: list[str] | None) -> DataFrame:
    """Rows of customers that have an open item in the given countries."""
    if not countries:
        return df
    wanted = items.filter(
        (F.col("source") == "BSID") & F.col("country").isin([c.upper() for c in countries])
    )
    return df.join(wanted.select("customer_id").distinct(), "customer_id", "left_semi")


def absent(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in `other`."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def override_class(scored: DataFrame, listed: DataFrame, items: DataFrame, codes: list[str],
                   override: str, column: str = "predicted_class") -> DataFrame:
    """`override` for listed customers that also have an item in one of the company codes."""
    hit = (
        items.filter(F.col("company_code").isin(codes))
        .join(listed.select("customer_id"), "customer_id", "left_semi")
        .select("customer_id").distinct().withColumn("_hit", F.lit(True))
    )
    return (
        scored.join(hit, "customer_id", "left")
        .withColumn(column, F.when(F.col("_hit"), override).otherwise(F.col(column)))
        .drop("_hit")
    )
