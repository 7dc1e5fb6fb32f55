"""Open and cleared line items from two raw tables.

Raw columns follow the SAP field names: KUNNR customer, BELNR invoice, BUZEI line,
BUKRS company code, WRBTR amount, ZFBDT baseline, AUGDT clearing, ZBD1T..ZBD3T terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.config import PanelConfig
from duescope.functions import columns as C
from duescope.functions import dates as D

CLEARED, OPEN = "BSAD", "BSID"


def _typed(raw: DataFrame, clearing: Column) -> DataFrame:
    return raw.select(
        F.col("KUNNR").alias("customer_id"),
        F.col("BELNR").alias("invoice_id"),
        F.col("BUZEI").alias("line_item_id"),
        F.col("BUKRS").alias("company_code"),
        F.col("WRBTR").cast("double").alias("invoice_amount"),
        D.compact_date(F.col("ZFBDT")).alias("baseline_date"),
        clearing.alias("clearing_date"),
        *[F.col(f"ZBD{i}T").cast("int").alias(f"terms_{i}") for i in (1, 2, 3)],
    )


def valid_baseline(raw: DataFrame) -> DataFrame:
    return raw.filter(D.valid_compact(F.col("ZFBDT")))


def cleared_items(bsad: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Cleared items with a valid baseline inside the lookback."""
    clearing = D.compact_date(F.col("AUGDT"))
    return within_lookback(_typed(valid_baseline(bsad), clearing), cfg)


def open_and_cleared(bsid: DataFrame, bsad: DataFrame) -> DataFrame:
    """Both item tables without filters; open items have no clearing date."""
    never = F.lit(None).cast("date")
    return _typed(bsid, never).unionByName(_typed(bsad, D.compact_date(F.col("AUGDT"))))


def tagged_items(bsid: DataFrame, bsad: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Valid items of both tables with source tag, due date and signed days past due."""
    never = F.lit(None).cast("date")
    cleared = _typed(valid_baseline(bsad), D.compact_date(F.col("AUGDT")))
    still_open = _typed(valid_baseline(bsid), never)
    both = cleared.withColumn("source", F.lit(CLEARED)).unionByName(
        still_open.withColumn("source", F.lit(OPEN))
    )
    terms = C.term_days(F.col("terms_3"), F.col("terms_2"), F.col("terms_1"))
    due = F.date_add("baseline_date", F.col("payment_terms_days"))
    settled_or_now = F.coalesce(F.col("clearing_date"), F.lit(cfg.anchor))
    return (
        within_lookback(both, cfg)
        .withColumn("payment_terms_days", terms)
        .withColumn("due_date", due)
        .withColumn("days_past_due", F.datediff(settled_or_now, F.col("due_date")))
    )


def within_lookback(df: DataFrame, cfg: PanelConfig, on: str = "baseline_date") -> DataFrame:
    if cfg.lookback_days is None:
        return df
    return df.filter(F.col(on) >= F.date_sub(F.lit(cfg.anchor), cfg.lookback_days))
