"""Scans, typed projections, filters and sinks."""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import functions as F

from duescope.functions import bands, columns, dates, encoding, weights
from duescope.operators import assemble, calendar, grain, lookups
from duescope.plans import fixtures as fx
from duescope.plans import sqlviews as sv
from duescope.plans.q_features import labelled, serving, training
from duescope.plans.registry import query
from duescope.sources import events, lineitems, sinks, view
from duescope.storage import new_path, stored

CFG = fx.CFG
A = sv.ANCHOR
_VALID = "regexp_full_match(trim(baseline_date), '[0-9]{8}') AND trim(baseline_date) <> '00000000'"
_ITEM = f"""customer_id, invoice_id, line_item AS line_item_id, company_code, invoice_amount,
  {sv.parsed('baseline_date')} AS baseline_date, {{clearing}} AS clearing_date,
  cash_discount_days_1 AS terms_1, cash_discount_days_2 AS terms_2, net_payment_days AS terms_3"""
_CLEAR = sv.parsed("clearing_date")
_ITEM_SPEC = "invoice_amount:2 baseline_date:d clearing_date:d"


@query("s01_cleared_item_scan", uses="raw", spec=_ITEM_SPEC, sql=f"""
SELECT {_ITEM.format(clearing=_CLEAR)} FROM raw
WHERE clearing_date IS NOT NULL AND {_VALID} AND {sv.parsed('baseline_date')} >= {A} - 730""")
def _(spark, path):
    return lineitems.cleared_items(fx.raw_cleared(spark, path), CFG)


@query("s02_open_and_cleared_scan", uses="raw", spec=_ITEM_SPEC, sql=f"""
SELECT {_ITEM.format(clearing="CASE WHEN clearing_date IS NOT NULL THEN " + _CLEAR + " END")}
FROM raw""")
def _(spark, path):
    return lineitems.open_and_cleared(fx.raw_open(spark, path), fx.raw_cleared(spark, path))


_T = ("coalesce(nullif(net_payment_days, 0), nullif(cash_discount_days_2, 0), "
      "nullif(cash_discount_days_1, 0), 0)")
sv.view("tagged", "raw", f"""
SELECT {_ITEM.format(clearing=_CLEAR)}, upper(source) AS source, {_T} AS payment_terms_days,
  {sv.parsed('baseline_date')} + {_T} AS due_date,
  CAST(coalesce({_CLEAR}, {A}) - ({sv.parsed('baseline_date')} + {_T}) AS INTEGER) AS days_past_due
FROM raw WHERE {_VALID} AND {sv.parsed('baseline_date')} >= {A} - 730""")


def tagged(spark, path):
    return lineitems.tagged_items(fx.raw_open(spark, path), fx.raw_cleared(spark, path), CFG)


@query("s03_tagged_items_with_dpd", uses="tagged", spec=_ITEM_SPEC + " due_date:d",
       sql="SELECT * FROM tagged")
def _(spark, path):
    return tagged(spark, path)


_VIEW_SPEC = ("invoice_amount:2 open_amount:2 fin_promised_amt:4 credit_limit:2 "
              "open_dispute_amount:4 dunning_level:0 dunning_count:0 fin_p2p_state:0 "
              "baseline_date:d document_entry_date:d clearing_date:d due_date:d "
              "last_dunned_date:d promise_dt:d dispute_create_date:d")


@query("s04_unified_view_scan", uses="typed", spec=_VIEW_SPEC,
       sql=f"SELECT * FROM typed WHERE baseline_date >= {A} - 730")
def _(spark, path):
    return view.view_items(fx.raw_view(spark, path), CFG)


@query("s04_unified_view_scan_full_history", uses="typed", spec=_VIEW_SPEC,
       sql="SELECT * FROM typed")
def _(spark, path):
    return view.typed_view(fx.raw_view(spark, path))


@query("s05_mode_scan_train", uses="typed", spec=_VIEW_SPEC, sql=f"""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed
WHERE upper(substr(company_code, 1, 2)) IN ('AA', 'BC') AND baseline_date >= {A} - 730""")
def _(spark, path):
    return view.mode_items(fx.raw_view(spark, path), CFG, "train", ["AA", "bc"])


@query("s05_mode_scan_serve_master_country", uses="typed", spec=_VIEW_SPEC, sql="""
SELECT * REPLACE (upper(country) AS country) FROM typed WHERE upper(country) = 'NATION_3'""")
def _(spark, path):
    cfg = CFG.with_(country_from="master")
    return view.mode_items(fx.raw_view(spark, path), cfg, "serve", ["nation_3"])


_AWARE = f"(source = 'BSID' OR coalesce(clearing_date, baseline_date) >= {A} - 730)"


@query("s06_source_aware_scan", uses="typed", spec=_VIEW_SPEC, sql=f"""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed WHERE {_AWARE}""")
def _(spark, path):
    return view.source_aware_items(fx.raw_view(spark, path), CFG)


@query("s06_source_aware_scan_pruned", uses="typed", spec=_VIEW_SPEC, sql=f"""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed WHERE {_AWARE}""")
def _(spark, path):
    """The same rows from a view stored in two parts, open and by month of settlement."""
    target = new_path(spark, "settled")
    view.store_settled(fx.raw_view(spark, path), CFG, target)
    return view.settled_items(spark, target, CFG)


@query("s07_single_country_scan", uses="typed", spec=_VIEW_SPEC, sql="""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed
WHERE upper(substr(company_code, 1, 2)) = 'CD'""")
def _(spark, path):
    return view.mode_items(fx.raw_view(spark, path), CFG, "serve", ["CD"])


def _clean(spark, path):
    target = new_path(spark, "view")
    view.store_clean(fx.raw_view(spark, path), CFG, target)
    return target


@query("s07_single_country_partition", uses="typed", spec=_VIEW_SPEC, sql="""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed
WHERE upper(substr(company_code, 1, 2)) = 'CD'""")
def _(spark, path):
    return view.clean_items(spark, _clean(spark, path), CFG, "serve", ["CD"])


@query("s05_train_scan_by_month", uses="typed", spec=_VIEW_SPEC, sql="""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country) FROM typed
WHERE baseline_date >= DATE '2001-08-01' - 730""")
def _(spark, path):
    return view.clean_items(spark, _clean(spark, path), CFG, "train")


@query("s08_dunning_event_scan", uses="letters", spec="dunning_date:d",
       sql="SELECT * FROM letters")
def _(spark, path):
    return fx.letters(spark, path)


@query("s09_promise_event_scan", uses="promises", spec="promise_date:d promised_amount:4",
       sql="SELECT * FROM promises")
def _(spark, path):
    return fx.promises(spark, path)


@query("s10_customer_master_scan", uses="master", sql="SELECT * FROM master")
def _(spark, path):
    return events.customer_master(fx.raw_master(spark, path))


# sinks write the given tables' derivations and read them back


@query("s12_partition_overwrite_sink", uses="items_all", spec="invoice_amount:2", sql="""
SELECT customer_id, invoice_id, line_item, invoice_amount, country FROM items_all""")
def _(spark, path):
    rows = fx.items(spark, path, mode="serve").select(
        "customer_id", "invoice_id", "line_item", "invoice_amount", "country")
    target = new_path(spark, "sink")
    for _run in range(2):  # a re-run replaces partitions instead of duplicating rows
        sinks.overwrite_partitions(rows, target, ["country"])
    return spark.read.schema(rows.schema).parquet(target)


@query("s12_overwrite_then_append_sink", uses="items_all", spec="invoice_amount:2", sql="""
SELECT customer_id, invoice_id, line_item, invoice_amount, source FROM items_all""")
def _(spark, path):
    rows = fx.items(spark, path, mode="serve").select(
        "customer_id", "invoice_id", "line_item", "invoice_amount", "source")
    target = new_path(spark, "sink")
    for i, source in enumerate((lineitems.OPEN, lineitems.CLEARED)):
        sinks.append_or_create(rows.filter(F.col("source") == source), target, first=i == 0)
    return spark.read.parquet(target)


@query("s15_refresh_stamp", uses="expo", spec="refresh_date:d snapshot_date:d", sql=f"""
SELECT customer_id, snapshot_date, 'ZZ' AS country, {A} AS refresh_date FROM expo
WHERE total_outstanding > 0""")
def _(spark, path):
    out = labelled(spark, path).select("customer_id", "snapshot_date", "country")
    return sinks.stamped(out, fx.ANCHOR, country="ZZ")


@query("s16_csv_sink", uses="inv_all", spec="invoice_amount:2", sql="""
SELECT customer_id, invoice_id, round(invoice_amount, 2) AS invoice_amount FROM inv_all""")
def _(spark, path):
    rows = fx.invoices(spark, path, mode="serve").select(
        "customer_id", "invoice_id", F.round("invoice_amount", 2).alias("invoice_amount"))
    target = new_path(spark, "sink")
    sinks.write_csv(rows, target)
    return spark.read.option("header", "true").schema(rows.schema).csv(target)


# projections


@query("p01_compact_date", uses="raw", spec="parsed:d", sql=f"""
SELECT invoice_id, line_item, baseline_date AS text_date, {sv.parsed('baseline_date')} AS parsed
FROM raw""")
def _(spark, path):
    return fx.raw_view(spark, path).select(
        "invoice_id", "line_item", F.col("baseline_date").alias("text_date"),
        dates.compact_date(F.col("baseline_date")).alias("parsed"))


@query("p02_any_date", uses="raw", spec="due:d promised:d entered:d", sql=f"""
SELECT invoice_id, line_item, {sv.either('due_date')} AS due, {sv.either('promise_dt')} AS promised,
  {sv.either('document_entry_date')} AS entered FROM raw""")
def _(spark, path):
    raw = fx.raw_view(spark, path)
    return raw.select("invoice_id", "line_item", *[
        dates.parse_date(raw, c).alias(n) for n, c in
        (("due", "due_date"), ("promised", "promise_dt"), ("entered", "document_entry_date"))])


@query("p03_plain_numbers", uses="raw", spec="invoice_amount:2 fin_promised_amt:2", sql="""
SELECT invoice_id, line_item, CAST(CAST(invoice_amount AS DECIMAL(18,2)) AS DOUBLE) AS invoice_amount,
  coalesce(CAST(fin_promised_amt AS DECIMAL(18,2)), 0) AS fin_promised_amt,
  coalesce(dunning_level, 0) AS dunning_level, promise_dt FROM raw""")
def _(spark, path):
    raw = fx.raw_view(spark, path).select(
        "invoice_id", "line_item", F.col("invoice_amount").cast("decimal(18,2)").alias("invoice_amount"),
        F.col("fin_promised_amt").cast("decimal(18,2)").alias("fin_promised_amt"),
        "dunning_level", "promise_dt")
    return columns.plain_numbers(raw)


@query("p05_recomputed_due_date", uses="items_all", spec="due_date:d", sql="""
SELECT customer_id, invoice_id, line_item, payment_terms_days, due_date FROM items_all""")
def _(spark, path):
    return fx.items(spark, path, mode="serve").select(
        "customer_id", "invoice_id", "line_item", "payment_terms_days", "due_date")


@query("p06_completed_due_date", uses="typed", spec="due_date:d", sql=f"""
SELECT invoice_id, line_item, coalesce(due_date, baseline_date + {_T}) AS due_date FROM typed""")
def _(spark, path):
    typed = view.typed_view(fx.raw_view(spark, path))
    return grain.completed_due_date(typed).select("invoice_id", "line_item", "due_date")


@query("p04_payment_term_days", uses="raw", sql=f"""
SELECT invoice_id, line_item, net_payment_days, cash_discount_days_2, cash_discount_days_1,
  {_T} AS payment_terms_days FROM raw""")
def _(spark, path):
    return grain.with_terms(fx.raw_view(spark, path)).select(
        "invoice_id", "line_item", *grain.TERMS, "payment_terms_days")


@query("p07_country_of_code", uses="raw", sql="""
SELECT DISTINCT company_code, upper(substr(company_code, 1, 2)) AS country FROM raw""")
def _(spark, path):
    return fx.raw_view(spark, path).select(
        "company_code", columns.country_of_code(F.col("company_code")).alias("country")).distinct()


@query("p08_stripped_customer_id", uses="raw", sql="""
SELECT DISTINCT customer_id, ltrim(customer_id, '0') AS stripped FROM raw""")
def _(spark, path):
    return fx.raw_view(spark, path).select(
        "customer_id", columns.strip_zeros(F.col("customer_id")).alias("stripped")).distinct()


@query("p09_overdue_floored", uses="inv_all", sql=f"""
SELECT customer_id, invoice_id,
  CAST(CASE WHEN due_date <= {A} THEN {A} - due_date ELSE 0 END AS INTEGER) AS dpd FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    return inv.select("customer_id", "invoice_id", dates.overdue_days(
        F.col("due_date"), F.lit(fx.ANCHOR)).alias("dpd"))


@query("p10_overdue_signed", uses="inv_all", sql=f"""
SELECT customer_id, invoice_id, CAST({A} - due_date AS INTEGER) AS dpd FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    return inv.select("customer_id", "invoice_id", dates.overdue_days(
        F.col("due_date"), F.lit(fx.ANCHOR), floored=False).alias("dpd"))


@query("p11_ages_and_delays", uses="inv_all", spec="days_to_pay:0 days_late:0", sql=f"""
SELECT customer_id, invoice_id, CAST({A} - baseline_date AS INTEGER) AS invoice_age,
  clearing_date - baseline_date AS days_to_pay, clearing_date - due_date AS days_late FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    between = dates.days_between
    return inv.select(
        "customer_id", "invoice_id",
        between(F.lit(fx.ANCHOR), F.col("baseline_date")).alias("invoice_age"),
        between(F.col("clearing_date"), F.col("baseline_date")).alias("days_to_pay"),
        between(F.col("clearing_date"), F.col("due_date")).alias("days_late"))


@query("p12_guarded_ratio", uses="inv_all", spec="promised_share:6", sql="""
SELECT customer_id, invoice_id, CASE WHEN open_amount > 0
  THEN coalesce(fin_promised_amt, 0) / open_amount ELSE 0 END AS promised_share FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    return inv.select("customer_id", "invoice_id", columns.ratio_or_zero(
        F.coalesce("fin_promised_amt", F.lit(0.0)), F.col("open_amount")).alias("promised_share"))


@query("p13_unguarded_share", uses="inv_all", spec="disputed_share:6", sql="""
SELECT customer_id, invoice_id, open_dispute_amount / nullif(open_amount, 0) AS disputed_share
FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    return inv.select("customer_id", "invoice_id", columns.share(
        F.col("open_dispute_amount"), F.col("open_amount")).alias("disputed_share"))


@query("p14_credit_utilisation", uses="expo", spec="snapshot_date:d credit_utilization:6",
       sql="SELECT customer_id, snapshot_date, credit_utilization FROM expo WHERE total_outstanding > 0")
def _(spark, path):
    return labelled(spark, path).select("customer_id", "snapshot_date", "credit_utilization")


@query("p15_tenure_at_snapshot", uses="expo", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, customer_tenure_days FROM expo WHERE total_outstanding > 0""")
def _(spark, path):
    return labelled(spark, path).select("customer_id", "snapshot_date", "customer_tenure_days")


@query("p16_activity_flag", uses="serve", sql="""
SELECT customer_id, CASE WHEN total_promises > 0 THEN 1 ELSE 0 END AS uses_promises FROM serve""")
def _(spark, path):
    return serving(spark, path).select(
        "customer_id", columns.activity_flag(F.col("total_promises")).alias("uses_promises"))


@query("p17_invoice_flags", uses="typed", spec="promise_kept:0", sql="""
SELECT invoice_id, line_item,
  CASE WHEN clearing_date IS NOT NULL AND clearing_date <= due_date THEN 1 ELSE 0 END AS is_on_time,
  CASE WHEN days_past_due > 0 THEN 1 ELSE 0 END AS is_late,
  CASE fin_p2p_state WHEN 3 THEN 1 WHEN 1 THEN 0 END AS promise_kept FROM typed""")
def _(spark, path):
    typed = view.typed_view(fx.raw_view(spark, path))
    return typed.select(
        "invoice_id", "line_item",
        columns.on_time_flag(F.col("clearing_date"), F.col("due_date")).alias("is_on_time"),
        columns.late_flag(F.col("days_past_due")).alias("is_late"),
        columns.kept_flag(F.col("fin_p2p_state")).alias("promise_kept"))


@query("p18_paid_on_time", uses="inv_all", sql="""
SELECT customer_id, invoice_id, CASE WHEN is_cleared = 1 AND clearing_date <= due_date THEN 1
  ELSE 0 END AS paid_on_time FROM inv_all""")
def _(spark, path):
    return fx.invoices(spark, path, mode="serve").select(
        "customer_id", "invoice_id", columns.paid_on_time(
            F.col("is_cleared"), F.col("clearing_date"), F.col("due_date")).alias("paid_on_time"))


@query("p19_ordinal_encode", uses="raw", sql="""
SELECT DISTINCT customer_id, risk_class, CASE risk_class WHEN 'A' THEN 0 WHEN 'B' THEN 1
  WHEN 'C' THEN 2 WHEN 'D' THEN 3 WHEN 'E' THEN 4 ELSE -1 END AS risk_class_ord,
  CASE WHEN risk_class IN ('A', 'B', 'C', 'D', 'E') THEN risk_class END AS decoded FROM raw""")
def _(spark, path):
    known = {k: v for k, v in encoding.RISK_CLASS_RANK.items() if k != "F"}
    rows = fx.raw_view(spark, path).select("customer_id", "risk_class").distinct()
    return encoding.ordinal(rows, "risk_class", known, label="decoded")


@query("p20_one_hot", uses="train", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, CASE WHEN country = 'AA' THEN 1 ELSE 0 END AS country_AA,
  CASE WHEN country = 'BB' THEN 1 ELSE 0 END AS country_BB,
  CASE WHEN substr(country, 1, 1) = 'A' THEN 1 ELSE 0 END AS cluster_A,
  CASE WHEN substr(country, 1, 1) = 'B' THEN 1 ELSE 0 END AS cluster_B,
  CASE WHEN substr(country, 1, 1) NOT IN ('A', 'B') THEN 1 ELSE 0 END AS cluster_other
FROM train""")
def _(spark, path):
    rows = labelled(spark, path).select(
        "customer_id", "snapshot_date", "country", F.substring("country", 1, 1).alias("cluster"))
    hot = encoding.one_hot(rows, "country", ["AA", "BB"], "country")
    return encoding.one_hot(hot, "cluster", ["A", "B"], "cluster", other="other").drop(
        "country", "cluster")


@query("p21_month_bucket", uses="panel", spec="snapshot_date:d month:d", sql="""
SELECT customer_id, snapshot_date, CAST(date_trunc('month', snapshot_date) AS DATE) AS month
FROM panel""")
def _(spark, path):
    inv = fx.invoices(spark, path)
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, CFG))
    return panel.withColumn("month", dates.month_of(F.col("snapshot_date")))


@query("p25_recency_weight", uses="panel", spec="snapshot_date:d weight:9", sql=f"""
SELECT DISTINCT snapshot_date,
  pow(0.5, greatest((SELECT max(snapshot_date) FROM panel) - snapshot_date, 0) / 180.0) AS weight
FROM panel""")
def _(spark, path):
    inv = fx.invoices(spark, path)
    dates_ = calendar.snapshot_panel(inv, calendar.calendar_for(inv, CFG)).select(
        "snapshot_date").distinct()
    last = dates_.agg(F.max("snapshot_date")).scalar()
    return dates_.withColumn("weight", weights.recency_weight(F.col("snapshot_date"), last))


@query("p26_class_weight", uses="train", spec="snapshot_date:d class_weight:9", sql="""
SELECT customer_id, snapshot_date, target, CASE WHEN target = 1 THEN 1.2 *
  (SELECT count(*) FILTER (target = 0) / greatest(count(*) FILTER (target = 1), 1) FROM train)
  ELSE 1 END AS class_weight FROM train""")
def _(spark, path):
    return weights.with_class_weight(
        labelled(spark, path), multiplier=1.2
    ).select("customer_id", "snapshot_date", "target", "class_weight")


@query("p28_feature_alignment", uses="train", spec="snapshot_date:d max_dpd:4 unseen_feature:4 "
       "total_outstanding:4 risk_class:4", sql="""
SELECT customer_id, snapshot_date, CAST(max_dpd AS DOUBLE) AS max_dpd, 0.0 AS unseen_feature,
  total_outstanding, 0.0 AS risk_class FROM train""")
def _(spark, path):
    names = ["max_dpd", "unseen_feature", "total_outstanding", "risk_class"]
    return columns.aligned(labelled(spark, path), names, ["customer_id", "snapshot_date"])


# filters


@query("f01_baseline_validity", uses="raw", sql=f"""
SELECT invoice_id, line_item, baseline_date FROM raw WHERE {_VALID}""")
def _(spark, path):
    return fx.raw_view(spark, path).filter(
        dates.valid_compact(F.col("baseline_date"))).select(
        "invoice_id", "line_item", "baseline_date")


@query("f02_lookback", uses="typed", spec="baseline_date:d", sql=f"""
SELECT invoice_id, line_item, baseline_date FROM typed WHERE baseline_date >= {A} - 730""")
def _(spark, path):
    typed = view.typed_view(fx.raw_view(spark, path))
    return lineitems.within_lookback(typed, CFG).select("invoice_id", "line_item", "baseline_date")


@query("f03_source_aware_lookback", uses="typed", spec="baseline_date:d", sql=f"""
SELECT invoice_id, line_item, baseline_date, source FROM typed WHERE {_AWARE}""")
def _(spark, path):
    typed = view.typed_view(fx.raw_view(spark, path))
    return view.source_aware_lookback(typed, CFG).select(
        "invoice_id", "line_item", "baseline_date", "source")


@query("f04_country_filter", uses="items_all", sql="""
SELECT invoice_id, line_item, country FROM items_all WHERE country IN ('AB', 'DE')""")
def _(spark, path):
    lines = fx.items(spark, path, mode="serve")
    return view.only_countries(lines, ["ab", "de"]).select("invoice_id", "line_item", "country")


@query("f05_open_at_snapshot", uses="inv_all", sql="""
SELECT customer_id, invoice_id FROM inv_all
WHERE clearing_date IS NULL OR clearing_date > DATE '2001-01-01'""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    at = F.lit("2001-01-01").cast("date")
    return inv.filter(calendar.open_at(at)).select("customer_id", "invoice_id")


@query("f06_open_at_snapshot_by_flag", uses="inv_all", sql="""
SELECT customer_id, invoice_id FROM inv_all
WHERE is_cleared = 0 OR clearing_date > DATE '2001-01-01'""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve")
    at = F.lit("2001-01-01").cast("date")
    return inv.filter(calendar.open_at_by_flag(at)).select("customer_id", "invoice_id")


@query("f08_selective_fill", uses="inv_all", spec="dunning_level:0 dunning_count:0", sql="""
SELECT customer_id, invoice_id, coalesce(dunning_level, 0) AS dunning_level, dunning_count
FROM inv_all""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve").select(
        "customer_id", "invoice_id", "dunning_level", "dunning_count")
    return columns.fill_listed(inv, ["dunning_level"])


# joins against dimensions and lists


@query("j07_master_join_filter", uses="inv_all master", spec="invoice_amount:2", sql="""
SELECT i.customer_id, i.invoice_id, i.invoice_amount, m.country, m.region FROM inv_all i
LEFT JOIN master m USING (customer_id) WHERE m.country IN ('NATION_1', 'NATION_2')""")
def _(spark, path):
    inv = fx.invoices(spark, path, mode="serve").select(
        "customer_id", "invoice_id", "invoice_amount")
    master = events.customer_master(fx.raw_master(spark, path))
    return lookups.with_master(inv, master, ["nation_1", "NATION_2"])


@query("j08_eligible_customers", uses="inv_all items_all", sql="""
SELECT customer_id, invoice_id FROM inv_all WHERE customer_id IN
  (SELECT customer_id FROM items_all WHERE source = 'BSID' AND country IN ('AC', 'EA'))""")
def _(spark, path):
    lines = fx.items(spark, path, mode="serve")
    return lookups.eligible(grain.invoices(lines), lines, ["AC", "EA"]).select(
        "customer_id", "invoice_id")


@query("j09_customers_by_calendar", uses="panel", spec="snapshot_date:d", sql="""
SELECT snapshot_date, count(*) AS customers FROM panel GROUP BY snapshot_date""")
def _(spark, path):
    inv = fx.invoices(spark, path)
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, CFG))
    return panel.groupBy("snapshot_date").agg(F.count("*").alias("customers"))


@query("j10_absent_from_view", uses="master items_all", sql="""
SELECT customer_id FROM master WHERE customer_id NOT IN (SELECT customer_id FROM items_all
  WHERE source = 'BSID')""")
def _(spark, path):
    open_lines = fx.items(spark, path, mode="serve").filter(F.col("source") == "BSID")
    return lookups.absent(events.customer_master(fx.raw_master(spark, path)), open_lines,
                          ["customer_id"]).select("customer_id")


@query("j12_do_not_target_override", uses="serve items_all", sql="""
SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM items_all
    WHERE company_code IN ('AB01', 'DC01')) AND CAST(customer_id AS BIGINT) % 3 = 0 THEN 'DNT'
  WHEN max_dpd > 60 THEN 'High' ELSE 'Low' END AS predicted_class FROM serve""")
def _(spark, path):
    lines = fx.items(spark, path, mode="serve")
    scored = serving(spark, path).select("customer_id", F.when(
        F.col("max_dpd") > 60, "High").otherwise("Low").alias("predicted_class"))
    listed = lines.select("customer_id").distinct().filter(
        F.col("customer_id").cast("bigint") % 3 == 0)
    return lookups.override_class(scored, listed, lines, ["AB01", "DC01"], "DNT")


# schema checks that SQL cannot state


@query("u04_train_serve_schema_difference", uses="train", sql=f"""
SELECT count(*) AS train_rows, {len(sv.NUMERIC_FEATURES)} AS n_features, '' AS train_only, '' AS serve_only FROM train""")
def _(spark, path):
    train, serve = training(spark, path), serving(spark, path)
    difference = assemble.schema_difference(train, serve)
    names = [f.name for f in train.schema.fields if f.name not in assemble.NOT_FEATURES]
    summary = train.agg(F.count("*").alias("train_rows"), F.lit(len(names)).alias("n_features"))
    return summary.withColumns({
        side: F.lit(",".join(missing)) for side, missing in difference.items()})


_RISKIER = "dpd|amt_.._plus|pct_.._plus|age$|days_to_pay|last_payment|dunning|broken|dispute|utilization"
_SAFER = "on_time|kept"


@query("p27_direction_prior", uses="train", spec="correlation:6", sql=f"""
SELECT feature, CASE WHEN isnan(c) THEN NULL ELSE c END AS correlation,
  CASE WHEN regexp_matches(feature, '{_SAFER}') THEN -1 WHEN regexp_matches(feature, '{_RISKIER}') THEN 1 ELSE 0 END AS direction
FROM (SELECT feature, corr(v, target) AS c FROM
  (UNPIVOT (SELECT target, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in sv.NUMERIC_FEATURES)} FROM train)
    ON {', '.join(sv.NUMERIC_FEATURES)} INTO NAME feature VALUE v) GROUP BY feature)""")
def _(spark, path):
    """Correlation sign of each feature with the label beside its prior direction."""
    from duescope.operators.directions import direction_prior

    train = training(spark, path)
    names = assemble.feature_names(train)
    stats = train.agg(*[columns.correlation(F.col(n), F.col("target")).alias(n) for n in names])
    long = stats.unpivot([], names, "feature", "correlation")
    return long.withColumn("direction", direction_prior(F.col("feature")))


def _dropped(spark, schema):
    with contextlib.suppress(Exception):  # the session may have gone before
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def _in_new_schema(spark):
    """A schema of its own whose tables live on the shared storage."""
    path = new_path(spark, "schema")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{path}'")
    atexit.register(_dropped, spark, name)  # the result is still to be read from it
    return name


_INV3 = "customer_id, invoice_id, round(invoice_amount, 2) AS invoice_amount"


@query("s11_table_overwrite_sink", uses="inv_all", spec="invoice_amount:2",
       sql=f"SELECT {_INV3} FROM inv_all")
def _(spark, path):
    schema = _in_new_schema(spark)
    rows = stored(fx.invoices(spark, path, mode="serve").select("customer_id", "invoice_id", "invoice_amount"))
    table = f"{schema}.invoices"
    sinks.overwrite_table(rows.drop("invoice_amount"), table)
    sinks.overwrite_table(rows, table)  # replaces data and schema
    return spark.table(table)


@query("s13_external_table", uses="inv_all", spec="invoice_amount:2", sql=f"SELECT {_INV3} FROM inv_all")
def _(spark, path):
    schema, location = _in_new_schema(spark), new_path(spark, "external")
    fx.invoices(spark, path, mode="serve").select("customer_id", "invoice_id", "invoice_amount").write.parquet(
        location)
    sinks.register_external(spark, f"{schema}.invoices", location)
    return spark.table(f"{schema}.invoices")


@query("s14_staging_and_production", uses="inv_all", spec="invoice_amount:2",
       sql=f"SELECT {_INV3} FROM inv_all")
def _(spark, path):
    schema = _in_new_schema(spark)
    rows = fx.invoices(spark, path, mode="serve").select("customer_id", "invoice_id", "invoice_amount")
    written = sinks.publish(rows, f"{schema}.staged", f"{schema}.live", promote=True)
    return spark.table(written[-1])
