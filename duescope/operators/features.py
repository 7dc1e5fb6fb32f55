"""Customer features at a snapshot, from one declaration per block.

A block lists *accumulators* (sums and maxima that merge) and the output columns computed
from them. Three plans feed the same accumulators:

* `on_calendar` - rows generate the shared calendar dates that see them; lifetime values
  are running totals per customer over at most one row per month. No join at all.
* `at_date` - one date for everybody: filter and group.
* `on_spine` - any (customer, date) spine: equi join on the customer with a residual date
  predicate. The general form, and the definition the other two are tested against.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.config import PanelConfig
from duescope.functions import columns as C
from duescope.functions import dates as D
from duescope.operators.calendar import LONGEST_GAP_DAYS, Calendar, open_at, spread
from duescope.storage import stored

KEY = ["customer_id", "snapshot_date"]


def _snapshot() -> Column:
    return F.col("snapshot_date")


@dataclass(frozen=True)
class Acc:
    """A mergeable per-group value: the sum or the maximum of `value` over chosen rows."""

    name: str
    kind: str                       # "sum" or "max"
    value: Column
    where: Column | None = None

    def over(self, extra: Column | None = None, suffix: str = "") -> Column:
        chosen = [c for c in (self.where, extra) if c is not None]
        value = self.value
        if chosen:
            condition = chosen[0] if len(chosen) == 1 else chosen[0] & chosen[1]
            value = F.when(condition, value)
        return {"sum": F.sum, "max": F.max}[self.kind](value).alias(self.name + suffix)


def _n(name: str, where: Column | None = None) -> Acc:
    return Acc(name, "sum", F.lit(1), where)


@dataclass(frozen=True)
class HistoryBlock:
    """Features over events dated up to the snapshot."""

    date: str
    lifetime: list[Acc]
    windowed: list[Acc]
    windows: tuple[int, ...]
    outputs: Callable[[], dict[str, Column]]
    derived: dict[str, Column] = field(default_factory=dict)

    def prepared(self, events: DataFrame) -> DataFrame:
        return events.filter(F.col(self.date).isNotNull()).withColumns(self.derived)

    def window_aggregates(self) -> list[Column]:
        out = []
        for w in self.windows:
            inside = F.col(self.date) >= F.date_sub(_snapshot(), w)
            out += [a.over(inside, f"_{w}") for a in self.windowed]
        return out

    def finished(self, grouped: DataFrame) -> DataFrame:
        return grouped.select(*KEY, *[c.alias(n) for n, c in self.outputs().items()])


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def behaviour_block(cfg: PanelConfig) -> HistoryBlock:
    """Payment behaviour from settled invoices (or settled lines, at line grain)."""
    late = "days_late" if cfg.on_time_basis == "due" else "days_to_pay"
    days = F.col("days_to_pay")
    per_window = [
        _n("n"), _n("on_time", F.col(late) <= 0),
        Acc("dtp_sum", "sum", days), _n("dtp_n", days.isNotNull()), Acc("dtp_max", "max", days),
    ]

    def outputs() -> dict[str, Column]:
        out = {
            "avg_days_to_pay": C.share(F.col("dtp_sum"), F.col("dtp_n")),
            "max_days_to_pay": F.col("dtp_max"),
            "on_time_ratio": C.share(_zero("on_time"), F.col("n")),
            "total_payments": F.col("n"),
            "days_since_last_payment": F.datediff(_snapshot(), F.col("last_paid")),
        }
        for w in cfg.windows:
            base = f"n_{w}" if cfg.window_denominator == "window" else "n"
            on_time = F.when(F.col(base) > 0, _zero(f"on_time_{w}"))
            out |= {
                f"avg_days_to_pay_{w}d": C.share(F.col(f"dtp_sum_{w}"), F.col(f"dtp_n_{w}")),
                f"max_days_to_pay_{w}d": F.col(f"dtp_max_{w}"),
                f"on_time_ratio_{w}d": C.share(on_time, F.col(base)),
                f"num_payments_{w}d": _zero(f"n_{w}"),
            }
        return out

    return HistoryBlock(
        date="clearing_date",
        derived={
            "days_to_pay": F.datediff("clearing_date", "baseline_date"),
            "days_late": F.datediff("clearing_date", "due_date"),
        },
        lifetime=[*per_window, Acc("last_paid", "max", F.col("clearing_date"))],
        windowed=per_window, windows=cfg.windows, outputs=outputs,
    )


def dunning_block(cfg: PanelConfig, date: str = "dunning_date", weight: str | None = None,
                  severe_from: int = 3) -> HistoryBlock:
    """Dunning letters; `weight` is a letter count per row, one letter if absent."""
    level = F.col("dunning_level")
    letters = F.lit(1) if weight is None else F.col(weight)
    per_window = [
        Acc("letters", "sum", letters), Acc("severe", "sum", letters, level >= severe_from),
    ]

    def outputs() -> dict[str, Column]:
        out = {
            "max_dunning_level": F.col("level_max"),
            "total_dunning_events": F.col("letters"),
            "avg_dunning_level": C.share(F.col("level_sum"), F.col("level_n")),
            "high_severity_dunning": _zero("severe"),
            "high_dunning_ratio": C.ratio_or_zero(_zero("severe"), F.col("letters")),
        }
        for w in cfg.windows:
            out |= {
                f"dunning_events_{w}d": _zero(f"letters_{w}"),
                f"high_severity_dunning_{w}d": _zero(f"severe_{w}"),
            }
        return out

    return HistoryBlock(
        date=date,
        lifetime=[
            *per_window, Acc("level_max", "max", level), Acc("level_sum", "sum", level),
            _n("level_n", level.isNotNull()),
        ],
        windowed=per_window, windows=cfg.windows, outputs=outputs,
    )


def promise_block(cfg: PanelConfig, date: str = "promise_date", state: str = "promise_state",
                  amount: str = "promised_amount") -> HistoryBlock:
    """Promises to pay; state 1 is broken, 3 is kept, others only count as promises."""
    per_window = [
        _n("n"), _n("broken", F.col(state) == 1), _n("kept", F.col(state) == 3),
        Acc("amount", "sum", F.col(amount)),
    ]

    def outputs() -> dict[str, Column]:
        n = F.col("n")
        out = {
            "total_promises": n,
            "broken_promises": _zero("broken"),
            "kept_promises": _zero("kept"),
            "total_promised_amount": F.col("amount"),
            "broken_ratio": C.ratio_or_zero(_zero("broken"), n),
            "kept_ratio": C.ratio_or_zero(_zero("kept"), n),
            "avg_promised_amount": C.ratio_or_zero(F.col("amount"), n),
            "promise_activity_flag": C.activity_flag(n),
        }
        for w in cfg.windows:
            out |= {
                f"promises_{w}d": _zero(f"n_{w}"),
                f"broken_{w}d": _zero(f"broken_{w}"),
                f"kept_{w}d": _zero(f"kept_{w}"),
                f"promised_amt_{w}d": F.col(f"amount_{w}"),
            }
        return out

    return HistoryBlock(
        date=date, lifetime=per_window, windowed=per_window, windows=cfg.windows, outputs=outputs,
    )


def history_on_calendar(events: DataFrame, block: HistoryBlock, calendar: Calendar,
                        history_days: int | None = None) -> DataFrame:
    """Block at every calendar date that has at least one event in its history.

    Each event generates the few dates within the longest window; the first of them also
    books the event into the running totals. With `history_days` the history itself is a
    window, so events generate all dates inside it and no running total is needed.
    """
    rows = block.prepared(events)
    day = F.col(block.date)
    if history_days is not None:
        seen = spread(rows, day, F.date_add(day, history_days), calendar)
        grouped = seen.groupBy(KEY).agg(
            *[a.over() for a in block.lifetime], *block.window_aggregates()
        )
        return block.finished(grouped)

    since = F.greatest(day, F.col("_first"))
    reach = max(*block.windows, LONGEST_GAP_DAYS)
    seen = spread(rows, day, F.date_add(since, reach), calendar)
    enters = _snapshot() == calendar.at_or_after(since)
    booked = seen.groupBy(KEY).agg(
        *[a.over(enters) for a in block.lifetime], *block.window_aggregates()
    )
    timeline = Window.partitionBy("customer_id").orderBy("snapshot_date")
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merge = {"sum": F.sum, "max": F.max}
    totals = booked.withColumns({
        **{a.name: merge[a.kind](a.name).over(so_far) for a in block.lifetime},
        "_next": F.lead("snapshot_date").over(timeline),
    }).withColumnRenamed("snapshot_date", "_own")
    until = F.coalesce(F.date_sub("_next", 1), F.col("_last"))
    dense = spread(totals, F.col("_own"), until, calendar)
    # dates between two booked ones repeat the totals; nothing lies in their windows
    own = _snapshot() == F.col("_own")
    recent = {
        f"{a.name}_{w}": F.when(own, F.col(f"{a.name}_{w}"))
        for w in block.windows for a in block.windowed
    }
    return block.finished(dense.withColumns(recent))


def history_at_date(events: DataFrame, block: HistoryBlock, at: Column,
                    history_days: int | None = None) -> DataFrame:
    """Block for all customers at one date: no join, one aggregation."""
    rows = block.prepared(events).withColumn("snapshot_date", at)
    day = F.col(block.date)
    known = day <= _snapshot()
    if history_days is not None:
        known = known & (day >= F.date_sub(_snapshot(), history_days))
    grouped = rows.filter(known).groupBy(KEY).agg(
        *[a.over() for a in block.lifetime], *block.window_aggregates()
    )
    return block.finished(grouped)


def history_join(events: DataFrame, spine: DataFrame, date: str,
                 history_days: int | None = None, how: str = "inner") -> DataFrame:
    """Events up to the snapshot (optionally only the last `history_days`) per spine row.

    `how="left"` keeps spine rows without events; columns of the events are then null.
    """
    e, s = events.alias("e"), spine.select(*KEY).alias("s")
    day = F.col(f"e.{date}")
    condition = (F.col("s.customer_id") == F.col("e.customer_id")) & (
        day <= F.col("s.snapshot_date")
    )
    if history_days is not None:
        condition = condition & (day >= F.date_sub("s.snapshot_date", history_days))
    kept = [F.col(f"e.{c}") for c in events.columns if c not in KEY]
    return s.join(e, condition, how).select("s.customer_id", "s.snapshot_date", *kept)


def history_on_spine(events: DataFrame, block: HistoryBlock, spine: DataFrame,
                     history_days: int | None = None, keep_spine: bool = False,
                     count_spine_rows: bool = False) -> DataFrame:
    """Block at the rows of an arbitrary spine.

    `keep_spine` returns spine rows without history too. `count_spine_rows` reproduces the
    count of a left join, where such a row counts as one payment.
    """
    rows = block.prepared(events)
    how = "left" if keep_spine else "inner"
    joined = history_join(rows, spine, block.date, history_days, how)
    present = F.col(block.date).isNotNull()
    grouped = joined.groupBy(KEY).agg(
        *[
            a.over() if count_spine_rows and a.name == "n" else a.over(present)
            for a in block.lifetime
        ],
        *block.window_aggregates(),
    )
    if keep_spine:
        grouped = grouped.na.fill(0, subset=[c for c in ("n", "letters") if c in grouped.columns])
    return block.finished(grouped)


def history_in_buckets(events: DataFrame, block: HistoryBlock, spine: DataFrame) -> DataFrame:
    """`history_on_spine` over an index of months: no row of a spine meets a customer's whole history.

    Events are summed up by customer and month. A spine row takes the running totals of the months
    before its own, the sums of the months wholly inside a window, and single events only in the
    months its date and its windows begin or end in. All joins are on customer and month, so the
    history of one large customer is spread over its months, and what meets is merged. They are merge
    joins by hint: a compressed table of months looks small enough to broadcast long before it is.
    """
    day, merge = F.col(block.date), {"sum": F.sum, "max": F.max}
    rows = block.prepared(events).withColumn("_month", F.trunc(day, "MM"))
    accs = {a.name: a for a in [*block.lifetime, *block.windowed]}
    months = stored(rows.groupBy("customer_id", "_month").agg(*[a.over() for a in accs.values()]))
    dates = stored(spine.select(*KEY).distinct().withColumn("_own", F.trunc("snapshot_date", "MM")))
    last = dates.agg(F.max("_own")).scalar()

    timeline = Window.partitionBy("customer_id").orderBy("_month")
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = months.select(
        "customer_id", F.add_months("_month", 1).alias("_from"), F.coalesce(F.lead("_month").over(timeline), last).alias("_to"),
        *[merge[a.kind](a.name).over(so_far).alias(a.name) for a in block.lifetime])
    step = F.expr("interval 1 month")
    known = totals.where(F.col("_from") <= F.col("_to")).withColumn("_own", F.explode(F.sequence("_from", "_to", step)))
    before = dates.join(known.drop("_from", "_to").hint("merge"), ["customer_id", "_own"])

    starts = {w: F.trunc(F.date_sub("snapshot_date", w), "MM") for w in block.windows}
    edges = F.array_distinct(F.array("_own", *starts.values()))
    single = dates.withColumn("_month", F.explode(edges)).join(
        rows.drop("snapshot_date").hint("merge"), ["customer_id", "_month"]).where(day <= _snapshot())
    inside = {w: day >= F.date_sub(_snapshot(), w) for w in block.windows}
    at_edge = {w: (F.col("_month") == F.col("_own")) | (F.col("_month") == starts[w]) for w in block.windows}

    def chosen(a: Acc, condition: Column) -> Column:
        return F.when(condition if a.where is None else condition & a.where, a.value)

    own = F.col("_month") == F.col("_own")
    events_at_edges = single.select(
        *KEY, *[chosen(a, own).alias(a.name) for a in block.lifetime],
        *[chosen(a, inside[w] & at_edge[w]).alias(f"{a.name}_{w}") for w in block.windows for a in block.windowed])

    widest = F.trunc(F.date_sub("snapshot_date", max(block.windows)), "MM")
    between = F.sequence(F.add_months(widest, 1), F.add_months("_own", -1), step)
    spans = dates.where(F.add_months(widest, 1) < F.col("_own")).withColumn("_month", F.explode(between))
    whole = spans.join(months.hint("merge"), ["customer_id", "_month"]).select(
        *KEY, *[F.when(F.col("_month") > starts[w], F.col(a.name)).alias(f"{a.name}_{w}") for w in block.windows for a in block.windowed])

    parts = before.drop("_own").unionByName(events_at_edges, allowMissingColumns=True).unionByName(whole, allowMissingColumns=True)
    kinds = {a.name: a.kind for a in block.lifetime} | {f"{a.name}_{w}": a.kind for w in block.windows for a in block.windowed}
    return block.finished(parts.groupBy(KEY).agg(*[merge[kind](name).alias(name) for name, kind in kinds.items()]))


# ---------------------------------------------------------------------------------------
# Exposure


BUCKETS = (30, 60, 90)
_EXTRAS = {  # optional invoice columns -> aggregate and output name
    "open_amount": (F.sum, "total_open_amount"),
    "credit_limit": (F.max, "credit_limit"),
    "number_of_disputes": (F.max, "number_of_disputes"),
    "open_dispute_amount": (F.sum, "open_dispute_amount"),
    "customer_tenure_days": (F.max, "customer_tenure_days"),
    "risk_class": (F.min, "risk_class"),
    "credit_group": (F.min, "credit_group"),
}


def _exposure(open_rows: DataFrame, cfg: PanelConfig, floored: bool, back_date_tenure: bool,
              label: bool) -> DataFrame:
    """Aggregate (invoice, snapshot) rows that are open. Invoice grain, so counting rows
    counts invoices. The label sum rides on the same rows and the same shuffle."""
    amount = F.col("invoice_amount")
    rows = open_rows.withColumns({
        "dpd": D.overdue_days(F.col("due_date"), _snapshot(), floored),
        "invoice_age": F.datediff(_snapshot(), F.col("baseline_date")),
    })
    have = set(open_rows.columns)
    aggregates = [
        F.sum(amount).alias("total_outstanding"),
        F.count("*").alias("num_open_invoices"),
        F.max("dpd").alias("max_dpd"),
        F.avg("dpd").alias("avg_dpd"),
        *[
            F.sum(F.when(F.col("dpd") > b, amount).otherwise(0.0)).alias(f"amt_{b}_plus")
            for b in BUCKETS
        ],
        F.max("invoice_age").alias("oldest_invoice_age"),
        F.avg("invoice_age").alias("avg_invoice_age"),
    ]
    if "country" in have:
        aggregates.append(F.min("country").alias("country"))
    aggregates += [
        rule(source).alias(name) for source, (rule, name) in _EXTRAS.items() if source in have
    ]
    if label:
        soon = F.col("clearing_date") <= F.date_add(_snapshot(), cfg.horizon_days)
        aggregates.append(F.sum(F.when(soon, amount)).alias("collected_30d"))
    return with_exposure_ratios(
        rows.groupBy(KEY).agg(*aggregates), cfg if back_date_tenure else None
    )


def with_exposure_ratios(grouped: DataFrame, tenure_cfg: PanelConfig | None = None) -> DataFrame:
    total = F.col("total_outstanding")
    out = grouped.withColumns({
        "avg_invoice_size": C.share(total, F.col("num_open_invoices")),
        **{f"pct_{b}_plus": C.share(F.col(f"amt_{b}_plus"), total) for b in BUCKETS},
    })
    if "credit_limit" in grouped.columns:
        out = out.withColumn(
            "credit_utilization", C.ratio_or_zero(total, F.col("credit_limit"))
        )
    if tenure_cfg is not None and "customer_tenure_days" in grouped.columns:
        moved = C.tenure_at(
            F.col("customer_tenure_days"), F.lit(tenure_cfg.anchor), _snapshot()
        )
        out = out.withColumn("customer_tenure_days", moved)
    return out


def exposure_on_calendar(invoices: DataFrame, cfg: PanelConfig, calendar: Calendar,
                         floored: bool = True, label: bool = False) -> DataFrame:
    """An invoice is open at the calendar dates in [baseline, clearing)."""
    until = F.coalesce(F.date_sub("clearing_date", 1), F.col("_last"))
    rows = spread(invoices, F.col("baseline_date"), until, calendar)
    return _exposure(rows, cfg, floored, back_date_tenure=True, label=label)


def open_join(invoices: DataFrame, spine: DataFrame) -> DataFrame:
    """Spine rows with their invoices already issued and still open at the snapshot."""
    i, s = invoices.alias("i"), spine.select(*KEY).alias("s")
    issued = (F.col("i.customer_id") == F.col("s.customer_id")) & (
        F.col("i.baseline_date") <= F.col("s.snapshot_date")
    )
    joined = i.join(s, issued, "inner").select("i.*", "s.snapshot_date")
    return joined.filter(open_at(_snapshot()))


def exposure_on_spine(invoices: DataFrame, cfg: PanelConfig, spine: DataFrame,
                      floored: bool = True, back_date_tenure: bool = True) -> DataFrame:
    return _exposure(open_join(invoices, spine), cfg, floored, back_date_tenure, label=False)


def exposure_at_date(invoices: DataFrame, cfg: PanelConfig, at: Column,
                     floored: bool = True) -> DataFrame:
    """Open invoices at one date, grouped by customer; tenure is already as of that date."""
    rows = invoices.withColumn("snapshot_date", at).filter(
        (F.col("baseline_date") <= _snapshot()) & open_at(_snapshot())
    )
    return _exposure(rows, cfg, floored, back_date_tenure=False, label=False)


def exposure_for_spine(open_rows: DataFrame, spine: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Serve shape: every spine customer, numbers 0 when nothing is open, unfloored dpd.

    Nulls become 0 before the ratios, so ratios of customers without exposure are null.
    """
    grouped = open_rows.withColumns({
        "dpd": D.overdue_days(F.col("due_date"), _snapshot(), floored=False),
        "invoice_age": F.datediff(_snapshot(), F.col("baseline_date")),
    }).groupBy(KEY).agg(
        F.sum("invoice_amount").alias("total_outstanding"),
        F.count("*").alias("num_open_invoices"),
        F.max("dpd").alias("max_dpd"),
        F.avg("dpd").alias("avg_dpd"),
        *[
            F.sum(F.when(F.col("dpd") > b, F.col("invoice_amount")).otherwise(0.0))
            .alias(f"amt_{b}_plus") for b in BUCKETS
        ],
        F.max("invoice_age").alias("oldest_invoice_age"),
        F.avg("invoice_age").alias("avg_invoice_age"),
    )
    kept = spine.select(*KEY).join(grouped, KEY, "left").na.fill(0)
    return with_exposure_ratios(kept)
