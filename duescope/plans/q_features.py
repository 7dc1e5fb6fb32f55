"""Panel, feature blocks, label and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from duescope.operators import assemble, calendar, features, label
from duescope.plans import fixtures as fx
from duescope.plans import sqlviews as sv
from duescope.plans.registry import query
from duescope.storage import stored

CFG = fx.CFG


# line columns: what amounts, dates and labels come from, and with them all that exposure comes from
PAID = ("customer_id", "invoice_id", "invoice_amount", "baseline_date", "due_date", "clearing_date", "country")
EXPOSED = (*PAID, "open_amount", "credit_limit", "number_of_disputes", "open_dispute_amount", "customer_tenure_days", "risk_class", "credit_group")


def panel_of(spark, path, columns=PAID, cfg=CFG):
    """Invoices with the attributes that come from `columns` of their lines, and their calendar. The scan
    is stored: the calendar starts at the earliest baseline, so a plan over lines would scan them twice."""
    inv = stored(fx.grain.invoices(fx.items(spark, path, cfg).select(*columns)))
    return inv, calendar.calendar_for(inv, cfg)


@query("flagship_labelled_panel", uses="expo label",
       spec="snapshot_date:d total_outstanding:4 amt_90_plus:4 collected_30d:4", sql="""
SELECT customer_id, snapshot_date, total_outstanding, max_dpd, amt_90_plus,
  coalesce(collected_30d, 0) AS collected_30d,
  CASE WHEN coalesce(collected_30d, 0) / total_outstanding < 0.4 THEN 1 ELSE 0 END AS target
FROM expo LEFT JOIN label USING (customer_id, snapshot_date) WHERE total_outstanding > 0""")
def flagship(spark, path):
    inv, cal = panel_of(spark, path)
    panel = features.exposure_on_calendar(inv, CFG, cal, label=True).na.fill(0)
    panel = label.with_label(panel.filter(F.col("total_outstanding") > 0), CFG)
    return panel.select("customer_id", "snapshot_date", "total_outstanding", "max_dpd",
                        "amt_90_plus", "collected_30d", "target")


@query("w01_snapshot_panel", uses="panel", spec="snapshot_date:d", sql="SELECT * FROM panel")
def _(spark, path):
    return calendar.snapshot_panel(*panel_of(spark, path))


@query("a04_exposure_features", uses="expo", spec=sv.EXPOSURE_SPEC, sql="SELECT * FROM expo")
def _(spark, path):
    inv, cal = panel_of(spark, path, EXPOSED)
    return features.exposure_on_calendar(inv, CFG, cal)


@query("a06_behaviour_features", uses="behav", spec=sv.BEHAVIOUR_SPEC, sql="SELECT * FROM behav")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    return features.history_on_calendar(inv, features.behaviour_block(CFG), cal)


@query("a09_dunning_features_events", uses="dunn", spec=sv.DUNNING_SPEC, sql="SELECT * FROM dunn")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    known = customers_of(inv, fx.letters(spark, path))
    return features.history_on_calendar(known, features.dunning_block(CFG), cal)


def customers_of(inv, events):
    """Events of customers in the panel; others have no panel row to attach to."""
    return events.join(inv.select("customer_id").distinct(), "customer_id", "left_semi")


@query("a11_promise_features_events", uses="prom", spec=sv.PROMISE_SPEC, sql="SELECT * FROM prom")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    known = customers_of(inv, fx.promises(spark, path))
    return features.history_on_calendar(known, features.promise_block(CFG), cal)


@query("a10_dunning_features_view", uses="dunn_view", spec=sv.DUNNING_SPEC,
       sql="SELECT * FROM dunn_view")
def _(spark, path):
    inv, cal = panel_of(spark, path, (*PAID, "dunning_level", "last_dunned_date", "dunning_count"))
    block = features.dunning_block(CFG, date="last_dunned_date", weight="dunning_count")
    return features.history_on_calendar(inv, block, cal)


@query("a12_promise_features_view", uses="prom_view", spec=sv.PROMISE_SPEC,
       sql="SELECT * FROM prom_view")
def _(spark, path):
    inv, cal = panel_of(spark, path, (*PAID, "promise_dt", "fin_p2p_state", "fin_promised_amt"))
    block = features.promise_block(CFG, "promise_dt", "fin_p2p_state", "fin_promised_amt")
    return features.history_on_calendar(inv, block, cal)


@query("a13_forward_label_sum", uses="label", spec="snapshot_date:d collected_30d:4",
       sql="SELECT * FROM label")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    return label.collected_on_calendar(inv, CFG, cal)


@query("j04_forward_label_interval_join", uses="label", spec="snapshot_date:d collected_30d:4",
       sql="SELECT * FROM label")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    return label.collected_on_spine(inv, CFG, calendar.snapshot_panel(inv, cal))


@query("j01_open_exposure_range_join", uses="expo", spec=sv.EXPOSURE_SPEC,
       sql="SELECT * FROM expo")
def _(spark, path):
    inv, cal = panel_of(spark, path, EXPOSED)
    return features.exposure_on_spine(inv, CFG, calendar.snapshot_panel(inv, cal))


@query("j02_history_join_range", uses="behav", spec=sv.BEHAVIOUR_SPEC, sql="SELECT * FROM behav")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    spine = calendar.snapshot_panel(inv, cal)
    return features.history_on_spine(inv, features.behaviour_block(CFG), spine)


@query("j02_history_join_buckets", uses="behav", spec=sv.BEHAVIOUR_SPEC, sql="SELECT * FROM behav")
def _(spark, path):
    """The same through an index of months, in which no customer's history stays in one place."""
    inv, cal = panel_of(spark, path)
    return features.history_in_buckets(inv, features.behaviour_block(CFG), calendar.snapshot_panel(inv, cal))


sv.history("paid_365", "inv", "clearing_date", "inv", sv._DAYS, floor=365)


@query("j02_history_join_floored", uses="paid_365", spec=sv.BEHAVIOUR_SPEC,
       sql=sv.behaviour_select("paid_365"))
def _(spark, path):
    inv, cal = panel_of(spark, path)
    return features.history_on_calendar(inv, features.behaviour_block(CFG), cal, 365)


_LEFT_PAID = """(SELECT p.customer_id, p.snapshot_date, i.clearing_date,
  i.clearing_date - i.baseline_date AS days_to_pay, i.clearing_date - i.due_date AS days_late
  FROM (SELECT DISTINCT customer_id, DATE '2001-08-01' AS snapshot_date FROM items_all
        WHERE source = 'BSID') p
  LEFT JOIN inv_all i ON i.customer_id = p.customer_id AND i.clearing_date <= p.snapshot_date
    AND i.clearing_date >= p.snapshot_date - 730)"""
_LEFT_COUNTS = """
SELECT customer_id, snapshot_date, avg(days_to_pay) AS avg_days_to_pay, {count} AS total_payments,
  max(clearing_date) AS last_paid, count(CASE WHEN clearing_date >= snapshot_date - 60 THEN 1 END) AS num_payments_60d
FROM {src} GROUP BY ALL"""


def _left_history(spark, path, quirk: bool):
    raw_items = fx.items(spark, path, mode="serve")
    inv = fx.grain.invoices(raw_items)
    spine = calendar.open_customers(raw_items, F.lit(fx.ANCHOR))
    out = features.history_on_spine(
        inv, features.behaviour_block(CFG), spine, 730, keep_spine=True, count_spine_rows=quirk
    )
    last = F.date_sub("snapshot_date", F.col("days_since_last_payment"))
    return out.select("customer_id", "snapshot_date", "avg_days_to_pay", "total_payments",
                      last.alias("last_paid"), "num_payments_60d")


@query("j03_history_left_join", uses="inv_all", spec="snapshot_date:d last_paid:d avg_days_to_pay:6",
       sql=_LEFT_COUNTS.format(count="count(clearing_date)", src=_LEFT_PAID))
def _(spark, path):
    return _left_history(spark, path, quirk=False)


@query("j03_history_left_join_row_count", uses="inv_all",
       spec="snapshot_date:d last_paid:d avg_days_to_pay:6",
       sql=_LEFT_COUNTS.format(count="count(*)", src=_LEFT_PAID))
def _(spark, path):
    return _left_history(spark, path, quirk=True)


@query("a07_behaviour_on_line_grain", uses="items panel", spec=sv.BEHAVIOUR_SPEC,
       sql=sv.behaviour_select("""(SELECT e.*, p.snapshot_date, e.clearing_date - e.baseline_date
  AS days_to_pay, e.clearing_date - e.due_date AS days_late FROM items e
  JOIN panel p ON e.customer_id = p.customer_id AND e.clearing_date <= p.snapshot_date)"""))
def _(spark, path):
    inv, cal = panel_of(spark, path)
    lines = fx.items(spark, path)
    return features.history_on_calendar(lines, features.behaviour_block(CFG), cal)


@query("a08_on_time_baseline_over_history", uses="paid", spec=sv.BEHAVIOUR_SPEC,
       sql=sv.behaviour_select("paid", late="days_to_pay", windowed=False))
def _(spark, path):
    inv, cal = panel_of(spark, path)
    cfg = CFG.with_(on_time_basis="baseline", window_denominator="history")
    return features.history_on_calendar(inv, features.behaviour_block(cfg), cal)


@query("a08_on_time_due_over_history", uses="paid", spec=sv.BEHAVIOUR_SPEC,
       sql=sv.behaviour_select("paid", windowed=False))
def _(spark, path):
    inv, cal = panel_of(spark, path)
    cfg = CFG.with_(window_denominator="history")
    return features.history_on_calendar(inv, features.behaviour_block(cfg), cal)


@query("w07_trailing_windows", uses="paid", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date,
  count(CASE WHEN clearing_date >= snapshot_date - 30 THEN 1 END) AS num_payments_30d,
  count(CASE WHEN clearing_date >= snapshot_date - 365 THEN 1 END) AS num_payments_365d
FROM paid GROUP BY ALL""")
def _(spark, path):
    inv, cal = panel_of(spark, path)
    block = features.behaviour_block(CFG.with_(windows=(30, 365)))
    return features.history_on_calendar(inv, block, cal).select(
        *features.KEY, "num_payments_30d", "num_payments_365d")


@query("a14_label", uses="train", spec=sv.LABEL_SPEC + " total_outstanding:4", sql="""
SELECT customer_id, snapshot_date, total_outstanding, collected_30d, collection_ratio, target
FROM train""")
def _(spark, path):
    return labelled(spark, path).select(*features.KEY, "total_outstanding", "collected_30d",
                                        "collection_ratio", "target")


def labelled(spark, path, cfg=CFG, columns=EXPOSED):
    """Exposure, label and target without history blocks: what most reports need. `PAID` is enough for
    those that read amounts, dates and the label only."""
    inv, cal = panel_of(spark, path, columns, cfg)
    return assemble.training_table(inv, [], cfg, cal)


def training(spark, path, cfg=CFG):
    inv, cal = panel_of(spark, path, EXPOSED, cfg)
    blocks = assemble.event_blocks(
        inv, fx.letters(spark, path), fx.promises(spark, path), cfg
    )
    return assemble.training_table(inv, blocks, cfg, cal)


@query("j05_training_table", uses="train", spec=sv.TRAIN_SPEC, sql="SELECT * FROM train")
def _(spark, path):
    return training(spark, path)


@query("j05_training_table_view", uses="train_view", spec=sv.TRAIN_SPEC,
       sql="SELECT * FROM train_view")
def _(spark, path):
    inv = stored(fx.invoices(spark, path))
    return assemble.training_table(inv, assemble.view_blocks(inv, CFG), CFG)


# serve side: one date, full history of invoices, history floor of 730 days

_AT = "DATE '2001-08-01'"
sv.view("spine_now", "items_all", f"""
SELECT customer_id, min(country) AS country, {_AT} AS snapshot_date FROM items_all
WHERE source = 'BSID' GROUP BY customer_id""")
sv.view("open_now", "inv_all", f"""
SELECT *, {_AT} AS snapshot_date, CASE WHEN due_date <= {_AT} THEN {_AT} - due_date ELSE 0 END AS dpd,
  {_AT} - baseline_date AS invoice_age FROM inv_all
WHERE baseline_date <= {_AT} AND (clearing_date IS NULL OR clearing_date > {_AT})""")
sv.view("expo_now", "open_now", sv.exposure_select("open_now", "snapshot_date", back_date=False,
                                                   country=False))
for _name, _events, _date, _uses, _extra in (
    ("paid_now", "inv_all", "clearing_date", "inv_all", sv._DAYS),
    ("dunned_now", "inv_all", "last_dunned_date", "inv_all", ""),
    ("promised_now", "inv_all", "promise_dt", "inv_all", ""),
):
    sv.history(_name, _events, _date, _uses, _extra, spine="spine_now", floor=730)
sv.view("behav_now", "paid_now", sv.behaviour_select("paid_now"))
sv.view("dunn_now", "dunned_now",
        sv.dunning_select("dunned_now", "last_dunned_date", "dunning_count"))
sv.view("prom_now", "promised_now", sv.promise_select(
    "promised_now", "promise_dt", "fin_p2p_state", "fin_promised_amt"))
sv.view("serve", "spine_now expo_now behav_now dunn_now prom_now", f"""
SELECT s.customer_id, s.country, s.snapshot_date, risk_class, credit_group, {sv._FILLED}
FROM spine_now s LEFT JOIN expo_now USING (customer_id, snapshot_date)
LEFT JOIN behav_now USING (customer_id, snapshot_date)
LEFT JOIN dunn_now USING (customer_id, snapshot_date)
LEFT JOIN prom_now USING (customer_id, snapshot_date)""")
SERVE_SPEC = sv.merged_spec(sv.EXPOSURE_SPEC, sv.BEHAVIOUR_SPEC, sv.DUNNING_SPEC, sv.PROMISE_SPEC)


def serving(spark, path, **kw):
    cfg = CFG.with_(history_days=730)
    lines = fx.items(spark, path, cfg, mode="serve")
    rolled = stored(fx.grain.invoices(lines, *calendar.open_lines()))  # the spine needs no scan of its own
    at = F.lit(fx.ANCHOR)
    inv, spine = rolled.drop("_has_open", "_open_country"), calendar.open_customers_of_invoices(rolled, at)
    return assemble.serving_table(inv, spine, assemble.view_blocks(inv, cfg), cfg, at, **kw)


@query("j06_serving_table", uses="serve", spec=SERVE_SPEC, sql="SELECT * FROM serve")
def _(spark, path):
    return serving(spark, path)


@query("f07_live_exposure_only", uses="serve", spec=SERVE_SPEC,
       sql="SELECT * FROM serve WHERE total_outstanding > 0")
def _(spark, path):
    return serving(spark, path, only_exposed=True)


@query("f09_presence_flags", uses="expo behav dunn prom", spec="snapshot_date:d", sql="""
SELECT e.customer_id, e.snapshot_date,
  CASE WHEN total_payments IS NOT NULL THEN 1 ELSE 0 END AS has_payment_history,
  CASE WHEN total_dunning_events IS NOT NULL THEN 1 ELSE 0 END AS has_dunning_history,
  CASE WHEN total_promises IS NOT NULL THEN 1 ELSE 0 END AS has_promise_history
FROM expo e LEFT JOIN behav USING (customer_id, snapshot_date)
LEFT JOIN dunn USING (customer_id, snapshot_date) LEFT JOIN prom USING (customer_id, snapshot_date)
WHERE total_outstanding > 0""")
def _(spark, path):
    return training(spark, path, CFG.with_(presence_flags=True)).select(
        *features.KEY, "has_payment_history", "has_dunning_history", "has_promise_history")


@query("a05_exposure_serve_shape", uses="spine_now open_now", spec="snapshot_date:d "
       "total_outstanding:4 amt_30_plus:4 amt_60_plus:4 amt_90_plus:4 avg_dpd:6 avg_invoice_age:6 "
       "avg_invoice_size:4 pct_30_plus:6 pct_60_plus:6 pct_90_plus:6", sql="""
SELECT customer_id, snapshot_date, total_outstanding, num_open_invoices, max_dpd, avg_dpd,
  amt_30_plus, amt_60_plus, amt_90_plus, oldest_invoice_age, avg_invoice_age,
  total_outstanding / nullif(num_open_invoices, 0) AS avg_invoice_size,
  amt_30_plus / nullif(total_outstanding, 0) AS pct_30_plus,
  amt_60_plus / nullif(total_outstanding, 0) AS pct_60_plus,
  amt_90_plus / nullif(total_outstanding, 0) AS pct_90_plus
FROM (SELECT s.customer_id, s.snapshot_date, coalesce(sum(invoice_amount), 0) AS total_outstanding,
  count(invoice_id) AS num_open_invoices, CAST(coalesce(max(late), 0) AS INTEGER) AS max_dpd,
  coalesce(avg(late), 0) AS avg_dpd,
  sum(CASE WHEN late > 30 THEN invoice_amount ELSE 0 END) AS amt_30_plus,
  sum(CASE WHEN late > 60 THEN invoice_amount ELSE 0 END) AS amt_60_plus,
  sum(CASE WHEN late > 90 THEN invoice_amount ELSE 0 END) AS amt_90_plus,
  CAST(coalesce(max(invoice_age), 0) AS INTEGER) AS oldest_invoice_age,
  coalesce(avg(invoice_age), 0) AS avg_invoice_age
  FROM spine_now s LEFT JOIN (SELECT *, snapshot_date - due_date AS late FROM open_now) o
    USING (customer_id, snapshot_date) GROUP BY s.customer_id, s.snapshot_date)""")
def _(spark, path):
    lines = fx.items(spark, path, mode="serve")
    at = F.lit(fx.ANCHOR)
    inv = fx.grain.invoices(lines).filter(F.col("baseline_date") <= at)
    return features.exposure_for_spine(
        calendar.open_now(inv, at), calendar.open_customers(lines, at), CFG)


@query("w04_point_snapshot", uses="open_now", spec="snapshot_date:d due_date:d invoice_amount:4",
       sql="""SELECT customer_id, invoice_id, snapshot_date, due_date, invoice_amount
FROM open_now""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve").filter(F.col("baseline_date") <= fx.ANCHOR)
    return calendar.open_now(inv, F.lit(fx.ANCHOR)).select(
        "customer_id", "invoice_id", "snapshot_date", "due_date", "invoice_amount")


@query("w05_spine_open_customers", uses="spine_now", spec="snapshot_date:d",
       sql="SELECT * FROM spine_now")
def _(spark, path):
    return calendar.open_customers(fx.items(spark, path, mode="serve"), F.lit(fx.ANCHOR))


@query("w06_spine_active_customers", uses="items_all", spec="snapshot_date:d",
       sql=f"SELECT DISTINCT customer_id, {_AT} AS snapshot_date FROM items_all")
def _(spark, path):
    return calendar.active_customers(fx.items(spark, path, mode="serve"), F.lit(fx.ANCHOR))


_CALENDAR_SQL = """
SELECT min(d) AS snapshot_date FROM (
  SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP),
    INTERVAL 7 DAY)) AS DATE) AS d) GROUP BY date_trunc('month', d)"""


def _dates(spark, path, cfg):
    inv = fx.invoices(spark, path, cfg)
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, cfg))
    return panel.select("snapshot_date").distinct()


@query("w02_censoring_cap", uses="inv", spec="snapshot_date:d", sql=_CALENDAR_SQL.format(
    first="(SELECT min(baseline_date) FROM inv)", last="(DATE '2001-08-01' - 30)"))
def _(spark, path):
    return _dates(spark, path, CFG)


@query("w02_no_cap", uses="inv", spec="snapshot_date:d", sql=_CALENDAR_SQL.format(
    first="(SELECT min(baseline_date) FROM inv)", last="DATE '2001-08-01'"))
def _(spark, path):
    return _dates(spark, path, CFG.with_(censor=False))


@query("w03_calendar_floor", uses="inv_all", spec="snapshot_date:d", sql=_CALENDAR_SQL.format(
    first="(SELECT greatest(min(baseline_date), DATE '2001-08-01' - 730) FROM inv_all)",
    last="(DATE '2001-08-01' - 30)"))
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, CFG))
    return panel.select("snapshot_date").distinct()


@query("w03_calendar_from_first_invoice", uses="inv_all", spec="snapshot_date:d",
       sql=_CALENDAR_SQL.format(first="(SELECT min(baseline_date) FROM inv_all)",
                                last="(DATE '2001-08-01' - 30)"))
def _(spark, path):
    cfg = CFG.with_(lookback_days=None)
    inv = fx.invoices(spark, path, cfg, mode="serve")
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, cfg))
    return panel.select("snapshot_date").distinct()
