"""The forward label: money collected after the snapshot, and whether it is too little."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.config import PanelConfig
from duescope.operators.calendar import Calendar, spread
from duescope.operators.features import KEY, open_join


def collected_on_calendar(invoices: DataFrame, cfg: PanelConfig, calendar: Calendar) -> DataFrame:
    """Amount open at the snapshot that clears within the horizon after it."""
    low = F.greatest("baseline_date", F.date_sub("clearing_date", cfg.horizon_days))
    rows = spread(
        invoices.filter(F.col("clearing_date").isNotNull()),
        low, F.date_sub("clearing_date", 1), calendar,
    )
    return rows.groupBy(KEY).agg(F.sum("invoice_amount").alias("collected_30d"))


def collected_on_spine(invoices: DataFrame, cfg: PanelConfig, spine: DataFrame) -> DataFrame:
    """The same by range join, for spines that are not a shared calendar."""
    horizon = F.date_add("snapshot_date", cfg.horizon_days)
    due_soon = open_join(invoices, spine).filter(
        F.col("clearing_date").between(F.col("snapshot_date"), horizon)
    )
    return due_soon.groupBy(KEY).agg(F.sum("invoice_amount").alias("collected_30d"))


def with_label(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """collection_ratio and target; expects total_outstanding > 0 and no null collections."""
    ratio = F.col("collected_30d") / F.col("total_outstanding")
    return df.withColumn("collection_ratio", ratio).withColumn(
        "target", F.when(F.col("collection_ratio") < cfg.high_risk_below, 1).otherwise(0)
    )
