"""Contributions, drivers and wording on a linear score fitted by one aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from duescope.functions import wording as W
from duescope.operators import explain as ex
from duescope.plans import sqlviews as sv
from duescope.plans.q_features import labelled
from duescope.plans.registry import query
from duescope.storage import stored

FEATURES = ["total_outstanding", "num_open_invoices", "max_dpd", "avg_dpd", "amt_30_plus",
            "pct_60_plus", "avg_invoice_age", "credit_utilization"]
_COLS = ", ".join(FEATURES)

sv.view("ex_wide", "expo label", f"""
SELECT e.customer_id, e.snapshot_date, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in FEATURES)},
  CASE WHEN coalesce(collected_30d, 0) / total_outstanding < 0.4 THEN 1 ELSE 0 END AS target
FROM expo e LEFT JOIN label USING (customer_id, snapshot_date) WHERE total_outstanding > 0""")
sv.view("ex_long", "ex_wide", f"""
UNPIVOT ex_wide ON {_COLS} INTO NAME feature VALUE value""")
sv.view("ex_drivers", "ex_long", """
SELECT l.customer_id, l.snapshot_date, l.feature, l.value, w * (l.value - m) AS contribution,
  row_number() OVER (PARTITION BY l.customer_id, l.snapshot_date
    ORDER BY abs(round(w * (l.value - m), 12)) DESC, l.feature) AS rank
FROM ex_long l JOIN (SELECT feature, coalesce(corr(value, target) / nullif(stddev_samp(value), 0), 0) AS w,
  avg(value) AS m FROM ex_long GROUP BY feature) s USING (feature)""")


def explained(spark, path):
    rows = stored(labelled(spark, path).select(
        "customer_id", "snapshot_date", "country", "target", *FEATURES))
    weights, means = ex.marginal_weights(rows, FEATURES)
    out = ex.linear_contributions(rows, weights, means)
    # ties at the twelfth digit are ties
    return out.withColumn("drivers", F.transform("drivers", lambda d: d.withField(
        "contribution", F.round(d["contribution"], 12))))


_KEY = ["customer_id", "snapshot_date"]


@query("x04_linear_contributions", uses="ex_drivers",
       spec="snapshot_date:d value:4 contribution:6", sql="""
SELECT customer_id, snapshot_date, feature, value, contribution FROM ex_drivers""")
def _(spark, path):
    return explained(spark, path).select(*_KEY, F.inline("drivers"))


@query("x05_top_drivers", uses="ex_drivers", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date,
  string_agg(feature || CASE WHEN contribution >= 0 THEN '(+)' ELSE '(-)' END, '; ' ORDER BY rank) AS top_risk_drivers,
  min(feature) FILTER (rank = 1) AS top_risk_driver FROM ex_drivers WHERE rank <= 3 GROUP BY 1, 2""")
def _(spark, path):
    return ex.top_drivers(explained(spark, path)).select(
        *_KEY, "top_risk_drivers", "top_risk_driver")


@query("x06_global_importance", uses="ex_drivers", spec="importance:8", sql="""
SELECT feature, avg(abs(contribution)) AS importance FROM ex_drivers GROUP BY feature""")
def _(spark, path):
    return ex.global_importance(explained(spark, path))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FORMATS = {"money": "format('{{:,.0f}}', round(value, 2))", "whole": "CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)",
            "percent": "format('{{:.0f}}', value * 100)"}
_SENTENCE = "CASE feature " + " ".join(
    "WHEN '{f}' THEN replace(replace({t}, '{{v}}', {v}), '{{i}}', impact)".format(
        f=f, t=_quoted(W.SENTENCES[f][1]),
        v=_FORMATS[W.SENTENCES[f][0]].replace("{{", "{").replace("}}", "}"))
    for f in FEATURES) + " END"
sv.view("ex_sentences", "ex_drivers", f"""
SELECT *, {_SENTENCE} AS sentence FROM (SELECT *, CASE WHEN contribution > 0 THEN 'increased risk'
  ELSE 'reduced risk' END AS impact FROM ex_drivers)""")


@query("x07_driver_sentences", uses="ex_sentences", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, feature, sentence FROM ex_sentences""")
def _(spark, path):
    rows = explained(spark, path).select(*_KEY, F.inline("drivers"))
    return rows.select(*_KEY, "feature", ex.sentence(
        F.col("feature"), F.col("value"), F.col("contribution")).alias("sentence"))


@query("x08_explanation_column", uses="ex_sentences", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, string_agg(sentence, ' | ' ORDER BY rank) AS collector_explanations
FROM ex_sentences WHERE rank <= 5 GROUP BY 1, 2""")
def _(spark, path):
    return ex.explanations(explained(spark, path)).select(*_KEY, "collector_explanations")


_PRETTY = "CASE feature " + " ".join(
    "WHEN '{f}' THEN {label} || ': ' || {v} || {unit} || ' — ' || impact".format(
        f=f, label=_quoted(W.LABELS[f][0]), unit=_quoted(f" {W.LABELS[f][2]}" if W.LABELS[f][2] else ""),
        v={"money": "format('{:,.0f}', v)", "round": "format('{:.0f}', v)",
           "percent": "format('{:.0f}', v * 100) || '%'"}[W.LABELS[f][1]])
    for f in FEATURES if f in W.LABELS) + (
    " ELSE feature || ' (' || format('{:.2f}', v) || ') ' || impact END")
sv.view("ex_phrases", "ex_drivers", f"""
SELECT customer_id, snapshot_date, rank, impact, {_PRETTY} AS pretty,
  feature || ' (' || format('{{:.2f}}', value) || ') ' || impact || '.' AS phrase
FROM (SELECT *, CAST(format('{{:.2f}}', value) AS DOUBLE) AS v,
  CASE WHEN contribution > 0 THEN 'increased risk' ELSE 'reduced risk' END AS impact
  FROM ex_drivers WHERE rank <= 5)""")
_NOTE_CLASS = "CASE CAST(customer_id AS BIGINT) % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' WHEN 2 THEN 'DNT' END"


def noted(spark, path):
    k = F.col("customer_id").cast("bigint") % 4
    predicted = F.when(k == 0, "High").when(k == 1, "Low").when(k == 2, "DNT")
    return ex.raw_phrases(explained(spark, path)).withColumn("predicted_class", predicted)


@query("x09_class_consistent_drivers", uses="ex_phrases", spec="snapshot_date:d", sql=f"""
SELECT customer_id, snapshot_date, coalesce(
  string_agg(pretty, ' | ' ORDER BY rank) FILTER (CASE cls WHEN 'High' THEN impact = 'increased risk'
    WHEN 'Low' THEN impact = 'reduced risk' ELSE TRUE END),
  string_agg(phrase, ' | ' ORDER BY rank)) AS note_drivers
FROM (SELECT *, {_NOTE_CLASS} AS cls FROM ex_phrases) GROUP BY 1, 2""")
def _(spark, path):
    rows = noted(spark, path)
    return rows.select(*_KEY, ex.rewritten(
        F.col("raw_explanations"), F.col("predicted_class")).alias("note_drivers"))


@query("x10_note_inputs", uses="ex_wide", spec="snapshot_date:d", sql=f"""
SELECT customer_id, snapshot_date, CASE {_NOTE_CLASS} WHEN 'High' THEN {_quoted(W.CLASS_MEANINGS['High'])}
  WHEN 'Low' THEN {_quoted(W.CLASS_MEANINGS['Low'])} WHEN 'DNT' THEN {_quoted(W.CLASS_MEANINGS['DNT'])} END AS class_meaning,
  CASE WHEN {_NOTE_CLASS} = 'DNT' THEN {_quoted(W.DNT_SUMMARY)} END AS fixed_note FROM ex_wide""")
def _(spark, path):
    return ex.note_inputs(noted(spark, path), "raw_explanations").select(
        *_KEY, "class_meaning", "fixed_note")
