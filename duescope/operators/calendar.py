"""The snapshot calendar: a stepped date sequence thinned to one date per month.

The dates are never materialised as a table. For a calendar that starts at `first` and
advances by `step_days`, the date kept in month M is the first one >= M that is congruent
to `first`, so it is a closed form of M. A row that is relevant for a date range therefore
*generates* its snapshots (`spread`) instead of being joined to a panel, which needs no
shuffle and does not depend on how rows are distributed over customers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.config import PanelConfig

LONGEST_GAP_DAYS = 38  # two kept dates are never further apart than this for steps up to 7


@dataclass(frozen=True)
class Calendar:
    first: Column
    last: Column
    step_days: int = 7

    def __post_init__(self):
        if not 1 <= self.step_days <= 7:
            raise ValueError("step_days must be between 1 and 7")

    def attach(self, df: DataFrame) -> DataFrame:
        """Bounds as columns, so that a bound taken from data is one scalar subquery."""
        return df.withColumns({"_first": self.first, "_last": self.last})

    def in_month(self, month: Column) -> Column:
        phase = F.pmod(F.datediff(F.col("_first"), month), F.lit(self.step_days))
        return F.greatest(F.date_add(month, phase), F.col("_first"))

    def at_or_after(self, day: Column) -> Column:
        """First snapshot >= day, for days not before the calendar start."""
        same = self.in_month(F.trunc(day, "MM"))
        following = self.in_month(F.add_months(F.trunc(day, "MM"), 1))
        return F.when(same >= day, same).otherwise(following)


def calendar_for(items: DataFrame, cfg: PanelConfig) -> Calendar:
    """From the earliest baseline, not before the lookback, to the anchor or the last
    date whose label window is complete.

    Lines and invoices have the same earliest baseline; lines need no roll-up for it.
    """
    earliest = items.agg(F.min("baseline_date").alias("d"))
    if cfg.lookback_days is not None:
        floor = F.date_sub(F.lit(cfg.anchor), cfg.lookback_days)
        earliest = earliest.select(F.greatest("d", floor).alias("d"))
    last = F.lit(cfg.anchor)
    if cfg.censor:
        last = F.date_sub(last, cfg.horizon_days)
    return Calendar(first=earliest.scalar(), last=last, step_days=cfg.step_days)


def spread(df: DataFrame, low: Column, high: Column, calendar: Calendar) -> DataFrame:
    """One output row per snapshot in [low, high]; rows that see no snapshot disappear.

    Keeps `_first` and `_last`; low and high may refer to them.
    """
    bounded = (
        calendar.attach(df)
        .withColumns({
            "_low": F.greatest(low, F.col("_first")),
            "_high": F.least(high, F.col("_last")),
        })
        .filter(F.col("_low") <= F.col("_high"))
    )
    months = F.sequence(
        F.trunc("_low", "MM"),
        F.trunc(F.greatest("_low", "_high"), "MM"),
        F.expr("interval 1 month"),
    )
    return (
        bounded.withColumn("_month", F.explode(months))
        .withColumn("snapshot_date", calendar.in_month(F.col("_month")))
        .filter(F.col("snapshot_date").between(F.col("_low"), F.col("_high")))
        .drop("_month", "_low", "_high")
    )


def snapshot_panel(invoices: DataFrame, calendar: Calendar) -> DataFrame:
    """Every customer at every calendar date: at most one row per customer and month."""
    customers = invoices.select("customer_id").distinct()
    return spread(customers, F.col("_first"), F.col("_last"), calendar).select(
        "customer_id", "snapshot_date"
    )


def open_customers(items: DataFrame, at: Column, source: str = "BSID") -> DataFrame:
    """Serve spine: customers with an open item, their country and one date."""
    return (
        items.filter(F.col("source") == source)
        .groupBy("customer_id").agg(F.min("country").alias("country"))
        .withColumn("snapshot_date", at)
    )


def open_lines(source: str = "BSID") -> tuple[Column, Column]:
    """Aggregates that `grain.invoices` takes along for `open_customers_of_invoices`."""
    is_open = F.col("source") == source
    return (F.max(is_open.cast("int")).alias("_has_open"), F.min(F.when(is_open, F.col("country"))).alias("_open_country"))


def open_customers_of_invoices(invoices: DataFrame, at: Column) -> DataFrame:
    """`open_customers` of the lines that `invoices` were rolled up from, with `open_lines`."""
    return (
        invoices.filter(F.col("_has_open") == 1)
        .groupBy("customer_id").agg(F.min("_open_country").alias("country"))
        .withColumn("snapshot_date", at)
    )


def active_customers(items: DataFrame, at: Column) -> DataFrame:
    """Serve spine variant: any customer with an item."""
    return items.select("customer_id").distinct().withColumn("snapshot_date", at)


def open_now(invoices: DataFrame, at: Column) -> DataFrame:
    """Point snapshot: invoices open at one date."""
    return invoices.withColumn("snapshot_date", at).filter(open_at(F.col("snapshot_date")))


def open_at(snapshot: Column) -> Column:
    """Not cleared, or cleared after the snapshot."""
    return F.col("clearing_date").isNull() | (F.col("clearing_date") > snapshot)


def open_at_by_flag(snapshot: Column) -> Column:
    """Flag form; a cleared row without a clearing date is not open."""
    return (F.col("is_cleared") == 0) | (F.col("clearing_date") > snapshot)
