"""Panel and feature blocks: edge cases, properties, equality of the physical plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from duescope.config import CORRECTED
from duescope.functions import bands, columns, dates
from duescope.operators import assemble, calendar, features, grain, label
from duescope.sources import sinks, view
from duescope.storage import new_path

ANCHOR = dt.date(2024, 6, 30)
CFG = CORRECTED(ANCHOR)
SCHEMA = ("customer_id string, invoice_id string, invoice_amount double, baseline_date date, "
          "due_date date, clearing_date date")


def random_invoices(spark, n=400, hot=0.4, seed=1):
    """One customer owns a large part of all invoices."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        base = ANCHOR - dt.timedelta(days=rng.randint(0, 700))
        due = base + dt.timedelta(days=rng.choice([0, 14, 30]))
        clear = base + dt.timedelta(days=rng.randint(0, 200)) if rng.random() < 0.8 else None
        customer = "hot" if rng.random() < hot else f"c{rng.randint(1, 12)}"
        rows.append((customer, str(i), float(rng.randint(-50, 500)), base, due, clear))
    return rows, spark.createDataFrame(rows, SCHEMA)


def calendar_dates(first, last, step=7):
    """The definition: step through the range, keep the first date of each month."""
    out, day = {}, first
    while day <= last:
        out.setdefault((day.year, day.month), day)
        day += dt.timedelta(days=step)
    return sorted(out.values())


def test_panel_matches_the_stepped_calendar(spark):
    rows, inv = random_invoices(spark)
    panel = calendar.snapshot_panel(inv, calendar.calendar_for(inv, CFG))
    got = sorted(r[0] for r in panel.select("snapshot_date").distinct().collect())
    first = max(min(r[3] for r in rows), ANCHOR - dt.timedelta(days=730))
    assert got == calendar_dates(first, ANCHOR - dt.timedelta(days=30))
    months = panel.groupBy("customer_id", F.trunc("snapshot_date", "MM")).count()
    assert months.filter("count > 1").count() == 0


def as_rows(df):
    ordered = df.select(*sorted(df.columns))
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r)
                  for r in ordered.collect())


@pytest.mark.parametrize("windows", [(60, 90, 180), (10,), (365,)])
def test_history_plans_agree(spark, windows):
    _, inv = random_invoices(spark)
    cfg = CFG.with_(windows=windows)
    cal = calendar.calendar_for(inv, cfg)
    block = features.behaviour_block(cfg)
    spine = calendar.snapshot_panel(inv, cal)
    joined = as_rows(features.history_on_spine(inv, block, spine))
    assert as_rows(features.history_on_calendar(inv, block, cal)) == joined
    floored = as_rows(features.history_on_spine(inv, block, spine, 200))
    assert as_rows(features.history_on_calendar(inv, block, cal, 200)) == floored


def test_history_before_the_calendar_counts(spark):
    """Events older than the first snapshot belong to the lifetime values."""
    early = [("a", "1", 10.0, dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 2, 1)),
             ("a", "2", 10.0, dt.date(2024, 1, 10), dt.date(2024, 1, 10), None)]
    inv = spark.createDataFrame(early, SCHEMA)
    cal = calendar.Calendar(F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 5, 1)))
    out = features.history_on_calendar(inv, features.behaviour_block(CFG), cal)
    assert {r["total_payments"] for r in out.collect()} == {1}
    assert out.count() == len(calendar_dates(dt.date(2024, 1, 10), dt.date(2024, 5, 1)))


def test_exposure_and_label_plans_agree(spark):
    _, inv = random_invoices(spark)
    cal = calendar.calendar_for(inv, CFG)
    spine = calendar.snapshot_panel(inv, cal)
    assert as_rows(features.exposure_on_calendar(inv, CFG, cal)) == as_rows(
        features.exposure_on_spine(inv, CFG, spine))
    want = as_rows(label.collected_on_spine(inv, CFG, spine))
    assert as_rows(label.collected_on_calendar(inv, CFG, cal)) == want
    merged = features.exposure_on_calendar(inv, CFG, cal, label=True).filter(
        "collected_30d is not null").select(*features.KEY, "collected_30d")
    assert as_rows(merged) == want


def test_clearing_on_the_snapshot_closes_the_invoice(spark):
    day = dt.date(2024, 3, 1)
    inv = spark.createDataFrame(
        [("a", "1", 10.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1), day)], SCHEMA)
    spine = spark.createDataFrame([("a", day)], "customer_id string, snapshot_date date")
    assert features.exposure_on_spine(inv, CFG, spine).count() == 0
    assert label.collected_on_spine(inv, CFG, spine).count() == 0
    paid = features.history_on_spine(inv, features.behaviour_block(CFG), spine).first()
    assert paid["total_payments"] == 1 and paid["days_since_last_payment"] == 0


def test_window_edges(spark):
    """An event exactly W days back is inside, one day more is outside."""
    at = dt.date(2024, 6, 1)
    rows = [("a", str(d), 1.0, dt.date(2023, 1, 1), at, at - dt.timedelta(days=d))
            for d in (60, 61, 90, 91, 180, 181)]
    inv = spark.createDataFrame(rows, SCHEMA)
    out = features.history_at_date(inv, features.behaviour_block(CFG), F.lit(at)).first()
    assert [out[f"num_payments_{w}d"] for w in (60, 90, 180)] == [1, 3, 5]


def test_promises_outside_known_states_only_count(spark):
    rows = [("a", s, 5.0, dt.date(2024, 5, 1)) for s in (0, 1, 2, 3, None)]
    events = spark.createDataFrame(
        rows, "customer_id string, promise_state int, promised_amount double, promise_date date")
    out = features.history_at_date(
        events, features.promise_block(CFG), F.lit(ANCHOR)).first()
    assert (out["total_promises"], out["broken_promises"], out["kept_promises"]) == (5, 1, 1)


def test_missing_dunning_level(spark):
    events = spark.createDataFrame(
        [("a", None, dt.date(2024, 5, 1)), ("a", 4, dt.date(2024, 5, 2))],
        "customer_id string, dunning_level int, dunning_date date")
    out = features.history_at_date(events, features.dunning_block(CFG), F.lit(ANCHOR)).first()
    assert (out["total_dunning_events"], out["avg_dunning_level"]) == (2, 4.0)
    assert out["high_dunning_ratio"] == 0.5


def test_training_drops_and_serving_keeps_negative_exposure(spark):
    rows = [("neg", "1", -10.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1), None),
            ("pos", "2", 10.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1), None)]
    inv = spark.createDataFrame(rows, SCHEMA)
    train = assemble.training_table(inv, [], CFG)
    assert {r[0] for r in train.select("customer_id").collect()} == {"pos"}
    spine = inv.select("customer_id").withColumn("snapshot_date", F.lit(ANCHOR))
    serve = assemble.serving_table(inv, spine, [], CFG, F.lit(ANCHOR))
    assert {r[0] for r in serve.select("customer_id").collect()} == {"neg", "pos"}


def test_training_invariants(spark):
    rows, inv = random_invoices(spark, n=600)
    positive = inv.withColumn("invoice_amount", F.abs("invoice_amount") + 1)
    out = assemble.training_table(positive, [], CFG)
    bad = out.filter(
        (F.col("amt_90_plus") > F.col("amt_60_plus")) | (F.col("amt_60_plus") > F.col("amt_30_plus"))
        | (F.col("amt_30_plus") > F.col("total_outstanding")) | (F.col("collection_ratio") > 1))
    assert bad.count() == 0 and out.count() > 0


def test_dates_and_terms(spark):
    df = spark.createDataFrame(
        [("00000000",), ("2024-01-05",), ("20240105",), (None,), ("20241301",), ("junk",)],
        "d string")
    got = [r[0] for r in df.select(dates.any_date(F.col("d"))).collect()]
    day = dt.date(2024, 1, 5)
    assert got == [None, day, day, None, None, None]
    terms = spark.createDataFrame([(0, 0, 0), (None, 14, 7), (0, 0, 7)], "a int, b int, c int")
    assert [r[0] for r in terms.select(
        columns.term_days(F.col("a"), F.col("b"), F.col("c"))).collect()] == [0, 14, 7]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.4,), (0.7,), (0.700001,), (1.0,)], "s double")
    got = [tuple(r) for r in df.select(
        bands.fixed_band(F.col("s")), bands.threshold_band(F.col("s"), F.lit(0.4))).collect()]
    assert got == [("Low", "Low"), ("Low", "Medium"), ("Medium", "High"), ("High", "High"),
                   ("High", "High")]


def test_latest_promise_state_wins(spark):
    items = spark.createDataFrame(
        [("a", "1", 1.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1), None, 3, dt.date(2024, 2, 1)),
         ("a", "1", 2.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1), None, 1, dt.date(2024, 3, 1))],
        SCHEMA + ", fin_p2p_state int, promise_dt date")
    row = grain.invoices(items).first()
    assert (row["invoice_amount"], row["fin_p2p_state"]) == (3.0, 1)


def test_source_aware_lookback_keeps_old_open_items(spark):
    old = dt.date(2000, 1, 1)
    df = spark.createDataFrame(
        [("o", "BSID", old, None), ("c", "BSAD", old, dt.date(2000, 2, 1)),
         ("r", "BSAD", old, ANCHOR)],
        "k string, source string, baseline_date date, clearing_date date")
    assert sorted(r[0] for r in view.source_aware_lookback(df, CFG).collect()) == ["o", "r"]


def test_partition_overwrite_is_repeatable(spark):
    df = spark.range(100).withColumn("country", F.when(F.col("id") % 3 == 0, "A").otherwise("B"))
    path = new_path(spark, "test")
    sinks.overwrite_partitions(df, path, ["country"])
    sinks.overwrite_partitions(df.filter("country = 'A'"), path, ["country"])
    assert spark.read.parquet(path).count() == 100


def test_publish_keeps_production_unless_promoted(spark):
    path = new_path(spark, "test")
    schema = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}'")
    df = spark.range(3)
    assert sinks.publish(df, f"{schema}.s", f"{schema}.p") == [f"{schema}.s"]
    assert not spark.catalog.tableExists(f"{schema}.p")
    assert not sinks.overwrite_table(df, f"{schema}.p", enabled=False)
    sinks.publish(df, f"{schema}.s", f"{schema}.p", promote=True)
    assert spark.table(f"{schema}.p").count() == 3
