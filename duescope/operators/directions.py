"""Expected direction of a feature: +1 more is riskier, -1 more is safer, 0 unknown."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Features with an unambiguous direction; any other is 0.
DIRECTION = {
    "max_dpd": 1, "avg_dpd": 1,
    "amt_30_plus": 1, "amt_60_plus": 1, "amt_90_plus": 1,
    "pct_30_plus": 1, "pct_60_plus": 1, "pct_90_plus": 1,
    "oldest_invoice_age": 1, "avg_invoice_age": 1, "credit_utilization": 1,
    "number_of_disputes": 1, "open_dispute_amount": 1,
    "avg_days_to_pay": 1, "avg_days_to_pay_60d": 1, "avg_days_to_pay_90d": 1, "avg_days_to_pay_180d": 1,
    "max_days_to_pay": 1, "max_days_to_pay_60d": 1, "max_days_to_pay_90d": 1, "max_days_to_pay_180d": 1,
    "days_since_last_payment": 1,
    "on_time_ratio": -1, "on_time_ratio_60d": -1, "on_time_ratio_90d": -1, "on_time_ratio_180d": -1,
    "max_dunning_level": 1, "avg_dunning_level": 1, "total_dunning_events": 1,
    "high_severity_dunning": 1, "high_dunning_ratio": 1,
    "dunning_events_60d": 1, "dunning_events_90d": 1, "dunning_events_180d": 1,
    "high_severity_dunning_60d": 1, "high_severity_dunning_90d": 1, "high_severity_dunning_180d": 1,
    "broken_promises": 1, "broken_ratio": 1, "broken_60d": 1, "broken_90d": 1, "broken_180d": 1,
    "kept_promises": -1, "kept_ratio": -1, "kept_60d": -1, "kept_90d": -1, "kept_180d": -1,
}


def direction_prior(feature: Column) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in DIRECTION.items()))
    return F.coalesce(F.try_element_at(table, feature), F.lit(0))
