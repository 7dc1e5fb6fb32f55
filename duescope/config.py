"""Run settings, passed explicitly so that every operator is reproducible."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PanelConfig:
    """Everything the feature build depends on besides its input tables."""

    anchor: dt.date
    lookback_days: int | None = 730      # floor on baseline dates and on the calendar
    windows: tuple[int, ...] = (60, 90, 180)
    step_days: int = 7                   # calendar step before one date per month is kept
    horizon_days: int = 30               # label window after the snapshot
    high_risk_below: float = 0.4         # collection ratio under which target = 1
    censor: bool = True                  # end the calendar at anchor - horizon
    history_days: int | None = None      # lower bound of history joins, None = all history
    on_time_basis: str = "due"           # "due": clearing <= due date, "baseline": days to pay <= 0
    window_denominator: str = "window"   # "window" or "history" for on_time_ratio_{W}d
    country_from: str = "company_code"   # or "master"
    count_spine_rows: bool = False       # True: a customer without payments counts one payment
    presence_flags: bool = False         # add has_*_history columns before nulls become 0

    def with_(self, **changes) -> "PanelConfig":
        return replace(self, **changes)


def CORRECTED(anchor: dt.date) -> PanelConfig:
    return PanelConfig(anchor=anchor)


def ORIGINAL(anchor: dt.date) -> PanelConfig:
    """Parity settings: diluted on-time windows, no censoring."""
    return PanelConfig(
        anchor=anchor, censor=False, on_time_basis="baseline", window_denominator="history"
    )
