"""Training and serving tables: exposure with the history blocks attached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.config import PanelConfig
from duescope.functions.columns import presence_flags
from duescope.operators import calendar as cal
from duescope.operators import features as feat
from duescope.operators.label import with_label

NOT_FEATURES = ("customer_id", "snapshot_date", "country", "region", "cluster", "risk_class",
                "credit_group", "collected_30d", "collection_ratio", "target",
                "payment_terms_days")
_PRESENCE = {
    "has_payment_history": "total_payments",
    "has_dunning_history": "total_dunning_events",
    "has_promise_history": "total_promises",
}


def view_blocks(invoices: DataFrame, cfg: PanelConfig) -> list[tuple[DataFrame, feat.HistoryBlock]]:
    """History blocks read from the invoice attributes of the unified view."""
    return [
        (invoices, feat.behaviour_block(cfg)),
        (invoices, feat.dunning_block(cfg, date="last_dunned_date", weight="dunning_count")),
        (invoices, feat.promise_block(cfg, "promise_dt", "fin_p2p_state", "fin_promised_amt")),
    ]


def event_blocks(invoices: DataFrame, letters: DataFrame, promises: DataFrame,
                 cfg: PanelConfig) -> list[tuple[DataFrame, feat.HistoryBlock]]:
    """History blocks read from the event logs, which cannot leak later states."""
    return [
        (invoices, feat.behaviour_block(cfg)),
        (letters, feat.dunning_block(cfg)),
        (promises, feat.promise_block(cfg)),
    ]


def _filled(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    if cfg.presence_flags:
        df = presence_flags(df, _PRESENCE)
    return df.na.fill(0)


def training_table(invoices: DataFrame, blocks: list[tuple[DataFrame, feat.HistoryBlock]],
                   cfg: PanelConfig, calendar: cal.Calendar | None = None) -> DataFrame:
    """Labelled panel: customers with positive exposure at each calendar date.

    `invoices` feeds every block, so pass a stored table when there are blocks to attach.
    """
    calendar = calendar or cal.calendar_for(invoices, cfg)
    out = feat.exposure_on_calendar(invoices, cfg, calendar, label=True)
    for events, block in blocks:
        part = feat.history_on_calendar(events, block, calendar, cfg.history_days)
        out = out.join(part, feat.KEY, "left")
    return with_label(_filled(out, cfg).filter(F.col("total_outstanding") > 0), cfg)


def serving_table(invoices: DataFrame, spine: DataFrame,
                  blocks: list[tuple[DataFrame, feat.HistoryBlock]], cfg: PanelConfig,
                  at: Column, only_exposed: bool = False) -> DataFrame:
    """Spine first, so customers without exposure stay unless `only_exposed`."""
    exposure = feat.exposure_at_date(invoices, cfg, at)
    if "country" in exposure.columns and "country" in spine.columns:
        exposure = exposure.drop("country")
    out = spine.join(exposure, feat.KEY, "left")
    for events, block in blocks:
        part = feat.history_at_date(events, block, at, cfg.history_days)
        out = out.join(part, feat.KEY, "left")
    out = _filled(out, cfg)
    return out.filter(F.col("total_outstanding") > 0) if only_exposed else out


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def schema_difference(train: DataFrame, serve: DataFrame) -> dict[str, list[str]]:
    """Feature columns present on one side only; both lists empty means parity."""
    a, b = set(feature_names(train)), set(feature_names(serve))
    return {"train_only": sorted(a - b), "serve_only": sorted(b - a)}
