"""Date parsing and day arithmetic, safe under ANSI mode (bad input becomes null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_iso(text: Column) -> tuple[Column, Column]:
    """Whether trimmed text can be `yyyyMMdd`, and the same with dashes. A cast would read past a time
    mark behind the day, hence the look at the last character."""
    dash, none = F.lit("-"), F.lit(0)
    iso = F.overlay(F.overlay(text, dash, F.lit(5), none), dash, F.lit(8), none)
    return (F.length(text) == 8) & F.substring(text, 8, 1).between("0", "9"), iso


def compact_date(c: Column) -> Column:
    """`yyyyMMdd` text to date; `00000000`, blanks and junk to null.

    Rearranged to ISO and cast, which is generated code and takes digits only; a format pattern is
    parsed by a formatter object per row, and a regular expression costs as much.
    """
    fits, iso = _as_iso(F.trim(c))
    return F.when(fits, iso.try_cast("date"))


def any_date(c: Column) -> Column:
    """Text in compact or ISO form to date; text with a dash can't be compact, so one cast serves both."""
    text = F.trim(c.cast("string"))
    fits, iso = _as_iso(text)
    return F.when(text.contains("-"), text).when(fits, iso).try_cast("date")


def parse_date(df, name: str) -> Column:
    """Date column whatever its storage type: native types are cast, text is parsed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return any_date(F.col(name))
    return F.col(name).cast("date")


def valid_compact(c: Column) -> Column:
    """Eight digits that are not all zero."""
    text = F.trim(c)
    return text.rlike("^[0-9]{8}$") & (text != "00000000")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def overdue_days(due: Column, at: Column, floored: bool = True) -> Column:
    """Days past due at a date; floored at 0 unless the serve variant is wanted."""
    days = F.datediff(at, due)
    return F.when(due <= at, days).otherwise(0) if floored else days


def month_of(c: Column) -> Column:
    return F.trunc(c, "MM")
