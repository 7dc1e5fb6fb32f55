"""The unified line-item view: one wide row per (customer, invoice, line)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duescope.config import PanelConfig
from duescope.functions import columns as C
from duescope.functions import dates as D
from duescope.sources.lineitems import CLEARED, OPEN, within_lookback

# Column types of the unified view.
TEXT = ("customer_id", "invoice_id", "line_item", "company_code", "currency", "payment_terms",
        "invoice_status", "country", "region", "risk_class", "credit_group", "payment_method")
MONEY = ("invoice_amount", "open_amount", "fin_promised_amt", "credit_limit",
         "open_dispute_amount")
WHOLE = ("cash_discount_days_1", "cash_discount_days_2", "net_payment_days", "days_past_due",
         "customer_tenure_days", "dunning_level", "dunning_count", "fin_p2p_state",
         "number_of_disputes")
DATES = ("baseline_date", "document_entry_date", "clearing_date", "due_date", "last_dunned_date",
         "promise_create_dt", "promise_dt", "dispute_create_date")


def typed_view(raw: DataFrame) -> DataFrame:
    """Typed projection of the columns present, known sources and valid baselines only."""
    have = [c for c in raw.columns]
    typed = raw.select(
        *[F.col(c) for c in TEXT if c in have],
        *[F.col(c).cast("double").alias(c) for c in MONEY if c in have],
        *[F.col(c).try_cast("int").alias(c) for c in WHOLE if c in have],
        *[D.parse_date(raw, c).alias(c) for c in DATES if c in have],
        F.upper("source").alias("source"),
    )
    return typed.filter(
        F.col("baseline_date").isNotNull() & F.col("source").isin(OPEN, CLEARED)
    )


def with_country(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Country from the company code prefix, or from the master column."""
    if cfg.country_from == "master":
        return df.withColumn("country", F.upper("country"))
    return df.withColumn("country", C.country_of_code(F.col("company_code")))


def only_countries(df: DataFrame, countries: list[str] | None) -> DataFrame:
    """Upper-cased IN list on the country column; no list keeps everything."""
    if not countries:
        return df
    return df.filter(F.col("country").isin([c.upper() for c in countries]))


def store_clean(raw: DataFrame, cfg: PanelConfig, path: str) -> None:
    """The typed view as a table: dates as dates, the country worked out once, files by country
    and month of the baseline. Scans of it are pruned by folder and by column statistics."""
    clean = with_country(typed_view(raw), cfg).withColumn("month", F.date_format("baseline_date", "yyyy-MM"))
    # a country's month of any size is written by several tasks, a small one by a single task
    (clean.hint("rebalance", "country", "month")
     .sortWithinPartitions("country", "month", "customer_id")
     .write.partitionBy("country", "month").mode("overwrite").parquet(path))


def clean_items(spark: SparkSession, path: str, cfg: PanelConfig, mode: str,
                countries: list[str] | None = None) -> DataFrame:
    """`mode_items` over what `store_clean` wrote: the same rows from the folders they can be in."""
    # the folder names are text, so that a country such as "NA" or a month stays as written
    stored_view = spark.read.option("mergeSchema", "false").parquet(path).withColumns({
        c: F.col(c).cast("string") for c in ("country", "month")})
    items = only_countries(stored_view, countries)
    if mode == "train" and cfg.lookback_days is not None:
        floor = cfg.anchor - dt.timedelta(days=cfg.lookback_days)
        items = items.filter(F.col("month") >= floor.strftime("%Y-%m"))
    items = items.drop("month")
    return within_lookback(items, cfg) if mode == "train" else items


def store_settled(raw: DataFrame, cfg: PanelConfig, path: str) -> None:
    """The typed view in two parts: open items, and cleared ones by the month they settled in (that
    of the clearing, or of the baseline where it is missing)."""
    clean = with_country(typed_view(raw), cfg)
    settled = F.when(F.col("source") == OPEN, "open").otherwise(F.date_format(F.coalesce("clearing_date", "baseline_date"), "yyyy-MM"))
    # a month of any size is written by several tasks, a small one by a single task
    (clean.withColumn("settled", settled).hint("rebalance", "settled")
     .sortWithinPartitions("settled", "country", "customer_id")
     .write.partitionBy("settled").mode("overwrite").parquet(path))


def settled_items(spark: SparkSession, path: str, cfg: PanelConfig, countries: list[str] | None = None) -> DataFrame:
    """`source_aware_items` over what `store_settled` wrote: the open part and the months that can
    lie inside the lookback, nothing else is read."""
    items = spark.read.option("mergeSchema", "false").parquet(path)
    if cfg.lookback_days is not None:
        floor = cfg.anchor - dt.timedelta(days=cfg.lookback_days)
        month = F.col("settled")  # folder names stay text: "open" is among them
        items = items.filter((month == "open") | (month >= floor.strftime("%Y-%m")))
    return source_aware_lookback(only_countries(items.drop("settled"), countries), cfg)


def view_items(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    return within_lookback(typed_view(raw), cfg)


def mode_items(raw: DataFrame, cfg: PanelConfig, mode: str,
               countries: list[str] | None = None) -> DataFrame:
    """Train mode floors the baseline at the lookback, serve mode reads full history."""
    items = only_countries(with_country(typed_view(raw), cfg), countries)
    return within_lookback(items, cfg) if mode == "train" else items


def source_aware_items(raw: DataFrame, cfg: PanelConfig,
                       countries: list[str] | None = None) -> DataFrame:
    """Open items always stay; cleared ones must have settled inside the lookback."""
    items = only_countries(with_country(typed_view(raw), cfg), countries)
    return source_aware_lookback(items, cfg)


def source_aware_lookback(items: DataFrame, cfg: PanelConfig) -> DataFrame:
    if cfg.lookback_days is None:
        return items
    floor = F.date_sub(F.lit(cfg.anchor), cfg.lookback_days)
    settled = F.coalesce("clearing_date", "baseline_date")
    return items.filter((F.col("source") == OPEN) | (settled >= floor))
