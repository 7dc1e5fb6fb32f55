"""Point-in-time receivables risk analytics as Spark DataFrame operators."""

from duescope.config import CORRECTED, ORIGINAL, PanelConfig

__all__ = ["CORRECTED", "ORIGINAL", "PanelConfig"]
