"""Score bands. Fixed cuts are right-closed, threshold-relative cuts are left-closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default cuts and band names, lowest risk first.
DEFAULT_CUTS = (0.4, 0.7)
BAND_NAMES = ("Low", "Medium", "High")


def fixed_band(score: Column, low_cut: Column | float = DEFAULT_CUTS[0],
               high_cut: Column | float = DEFAULT_CUTS[1]) -> Column:
    """[0, low] Low, (low, high] Medium, (high, 1] High; null outside [0, 1]."""
    low, high = (c if isinstance(c, Column) else F.lit(c) for c in (low_cut, high_cut))
    return (
        F.when((score < 0) | (score > 1), None)
        .when(score <= low, BAND_NAMES[0])
        .when(score <= high, BAND_NAMES[1])
        .when(score.isNotNull(), BAND_NAMES[2])
    )


def threshold_band(score: Column, threshold: Column, medium_width: float = 0.5) -> Column:
    """Low below t, Medium below t + width * (1 - t), High from there."""
    upper = threshold + F.lit(medium_width) * (F.lit(1.0) - threshold)
    return (
        F.when(score < threshold, BAND_NAMES[0])
        .when(score < upper, BAND_NAMES[1])
        .otherwise(BAND_NAMES[2])
    )


def flagged(score: Column, threshold: Column) -> Column:
    return (score >= threshold).cast("int")
