"""Due dates and the roll-up from line items to invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.functions import columns as C
from duescope.sources.lineitems import CLEARED

TERMS = ("net_payment_days", "cash_discount_days_2", "cash_discount_days_1")


def with_terms(df: DataFrame, terms: tuple[str, str, str] = TERMS) -> DataFrame:
    return df.withColumn("payment_terms_days", C.term_days(*[F.col(t) for t in terms]))


def recomputed_due_date(df: DataFrame, terms: tuple[str, str, str] = TERMS) -> DataFrame:
    """Baseline plus terms; a stored due date is ignored."""
    return with_terms(df, terms).withColumn(
        "due_date", F.date_add("baseline_date", F.col("payment_terms_days"))
    )


def completed_due_date(df: DataFrame, terms: tuple[str, str, str] = TERMS) -> DataFrame:
    """Stored due date, baseline plus terms where it is missing."""
    computed = F.date_add("baseline_date", F.col("payment_terms_days"))
    return with_terms(df, terms).withColumn("due_date", F.coalesce("due_date", computed))


# How a line column reaches the invoice. Attributes equal on all lines of an invoice take max
# or min, which is deterministic and combines before the shuffle.
_ALWAYS = {"invoice_amount": F.sum, "baseline_date": F.min, "due_date": F.min, "clearing_date": F.max}
_IF_PRESENT = {
    "open_amount": F.sum,
    "country": F.min, "region": F.min, "invoice_status": F.min,
    "dunning_level": F.max, "last_dunned_date": F.max, "dunning_count": F.max,
    "fin_promised_amt": F.max, "promise_dt": F.max,
    "risk_class": F.min, "credit_group": F.min, "credit_limit": F.max,
    "number_of_disputes": F.max, "open_dispute_amount": F.max, "customer_tenure_days": F.max,
}


def _rolled(items: DataFrame, rules: dict, *more: Column) -> DataFrame:
    return items.groupBy("customer_id", "invoice_id").agg(
        *[rule(name).alias(name) for name, rule in rules.items()], *more)


def invoices_narrow(items: DataFrame) -> DataFrame:
    """One row per (customer, invoice): amount, first baseline and due date, last clearing."""
    return _rolled(items, _ALWAYS)


def invoices(items: DataFrame, *others: Column) -> DataFrame:
    """One row per (customer, invoice) with every attribute of the view that is present.

    The promise state is that of the latest promise; equal dates take the higher state. `others`
    are further aggregates of the lines.
    """
    have = set(items.columns)
    more = list(others)
    if {"fin_p2p_state", "promise_dt"} <= have:
        dated = F.when(
            F.col("fin_p2p_state").isNotNull(), F.struct("promise_dt", "fin_p2p_state")
        )
        more.append(F.max(dated)["fin_p2p_state"].alias("fin_p2p_state"))
    if "source" in have:
        more.append(F.max((F.col("source") == CLEARED).cast("int")).alias("is_cleared"))
    return _rolled(items, _ALWAYS | {n: r for n, r in _IF_PRESENT.items() if n in have}, *more)
