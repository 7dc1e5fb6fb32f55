"""How often plans read the lines, how many copies of rows they write, and that their results stay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duescope.operators import calendar, grain, profile, splits
from duescope.plans import fixtures as fx
from duescope.plans import load_all, q_evaluate, q_features, q_train, registry

DATA = "/root/testdata/sf0.001"
DAY = dt.date(2001, 8, 1)
load_all()


@pytest.fixture
def scans(monkeypatch):
    """Plans of the order lines that were made; each one in a query is a scan and a join."""
    made, lines = [], fx._lines
    monkeypatch.setattr(fx, "_lines", lambda *a, **k: made.append(1) or lines(*a, **k))
    return made


def reads_lines(df):
    return "lineitem" in df._jdf.queryExecution().toString()


def test_labels_and_calendar_share_a_scan(spark, scans):
    assert not reads_lines(q_evaluate.scored(spark, DATA))
    assert len(scans) == 1


def test_serving_table_and_its_spine_share_a_scan(spark, scans):
    assert not reads_lines(q_features.serving(spark, DATA))
    assert len(scans) == 1


def test_funnel_scans_open_lines_once_and_all_lines_once(spark, scans):
    assert not reads_lines(registry.QUERIES["q06_universe_funnel"].build(spark, DATA))
    assert len(scans) == 2


def test_spine_of_invoices_is_the_spine_of_lines(spark):
    day = dt.date(2001, 7, 1)
    rows = [("a", "1", "BSID", "DE"), ("a", "1", "BSAD", "AT"), ("a", "2", "BSAD", "AA"), ("b", "3", "BSAD", "DE"), ("c", "4", "BSID", None),
            ("d", "5", "BSID", None), ("d", "6", "BSID", "FR"), ("d", "6", "BSID", "FR"), (None, "7", "BSID", "IT"), ("e", None, "BSID", "ES")]
    lines = spark.createDataFrame([(*r, 1.0, day, day, None) for r in rows], (
        "customer_id string, invoice_id string, source string, country string, invoice_amount double, "
        "baseline_date date, due_date date, clearing_date date"))
    want = calendar.open_customers(lines, F.lit(DAY))
    got = calendar.open_customers_of_invoices(grain.invoices(lines, *calendar.open_lines()), F.lit(DAY))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_fingerprint_computes_its_panel_once_and_without_other_columns(spark, monkeypatch):
    kept, stored = [], profile.stored
    monkeypatch.setattr(profile, "stored", lambda df: kept.append(df) or stored(df))
    panel = q_features.labelled(spark, DATA).withColumns({c: F.lit(1) for c in (
        "on_time_ratio", "avg_days_to_pay", "kept_ratio", "total_dunning_events", "high_severity_dunning", "promise_activity_flag")})
    assert profile.country_fingerprint(panel).count() > 0
    assert len(kept) == 1 and "amt_90_plus" not in kept[0].columns


def test_roles_told_at_once_are_the_same_and_need_no_copy(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(i, DAY - dt.timedelta(days=i % 13) if i % 7 else None) for i in range(90)], "id int, snapshot_date date")
    def of(df):
        return {r["id"]: r["role"] for r in df.collect()}
    assert of(splits.quantile_split(rows, told=True)) == of(splits.quantile_split(rows))
    none = rows.where("false")
    assert splits.quantile_split(none, told=True).collect() == []
    kept, stored = [], q_train.stored
    monkeypatch.setattr(q_train, "stored", lambda df: kept.append(1) or stored(df))
    q_train.split_and_fit(spark, DATA)
    assert len(kept) == 1


def test_tasks_stay_small_unless_the_session_says_otherwise(spark):
    before = spark.conf.get(registry.TASK_INPUT)
    try:
        spark.conf.unset(registry.TASK_INPUT)
        assert registry.tuned(spark).conf.get(registry.TASK_INPUT) == "16m"
        spark.conf.set(registry.TASK_INPUT, "8m")
        assert registry.tuned(spark).conf.get(registry.TASK_INPUT) == "8m"
    finally:
        spark.conf.set(registry.TASK_INPUT, before)
