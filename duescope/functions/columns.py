"""Small column rules shared by all feature blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den where den > 0, else 0."""
    return F.when(den > 0, num / den).otherwise(0.0)


def share(num: Column, den: Column) -> Column:
    """num / den, null when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are known; null where one side is constant,
    for which `corr` is a division by zero in ANSI mode."""
    x, y = x.cast("double"), y.cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def term_days(net: Column, discount_2: Column, discount_1: Column) -> Column:
    """First non-zero of net days, second and first discount days; 0 if none is set."""
    zero = F.lit(0)
    return F.coalesce(
        F.nullif(net, zero), F.nullif(discount_2, zero), F.nullif(discount_1, zero), zero
    ).cast("int")


def country_of_code(company_code: Column) -> Column:
    return F.upper(F.substring(company_code, 1, 2))


def strip_zeros(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "^0+", "")


def tenure_at(tenure: Column, as_of: Column, snapshot: Column) -> Column:
    """Tenure known today, moved back to the snapshot and never negative."""
    return F.greatest(tenure - F.datediff(as_of, snapshot), F.lit(0))


def activity_flag(count: Column) -> Column:
    return F.when(count > 0, 1).otherwise(0)


def on_time_flag(clearing: Column, due: Column) -> Column:
    return F.when(clearing.isNotNull() & (clearing <= due), 1).otherwise(0)


def late_flag(days_past_due: Column) -> Column:
    return F.when(days_past_due > 0, 1).otherwise(0)


def kept_flag(state: Column) -> Column:
    """1 kept, 0 broken, null when the promise is neither."""
    return F.when(state == 3, 1).when(state == 1, 0)


def paid_on_time(is_cleared: Column, clearing: Column, due: Column) -> Column:
    return F.when((is_cleared == 1) & (clearing <= due), 1).otherwise(0)


def plain_numbers(df: DataFrame, fill: float | None = 0) -> DataFrame:
    """Decimals to double in one projection, then numeric nulls to `fill`."""
    out = df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    return out if fill is None else out.na.fill(fill)


def fill_listed(df: DataFrame, names: list[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, subset=names)


def presence_flags(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """flag name -> column whose null means "no history"; apply before filling nulls."""
    return df.withColumns({k: F.col(v).isNotNull().cast("int") for k, v in flags.items()})


def aligned(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """Exactly `names` as doubles in this order; missing columns and bad values become 0."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            F.coalesce(F.col(n).try_cast("double"), F.lit(0.0)).alias(n)
            if n in have else F.lit(0.0).alias(n)
            for n in names
        ],
    )
