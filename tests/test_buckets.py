"""History over the index of months against the plain range join."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duescope.config import CORRECTED
from duescope.operators import features

CFG = CORRECTED(dt.date(2024, 6, 1))


@pytest.fixture(scope="module")
def tables(spark):
    """Invoices of sixty customers, a third of them one customer's; spine dates of all kinds."""
    rng, rows = random.Random(6), []
    for i in range(1500):
        who = "hot" if i % 3 == 0 else f"c{rng.randrange(60):02d}"
        base = dt.date(2022, 1, 1) + dt.timedelta(days=rng.randrange(880))
        paid = None if rng.random() < 0.1 else base + dt.timedelta(days=rng.randrange(120))
        rows.append((who, f"i{i}", base, base + dt.timedelta(days=30), paid, rng.random() * 100, rng.randrange(1, 5), rng.choice([1, 2, 3, None])))
    rows.append(("alone", "x", dt.date(2024, 5, 1), dt.date(2024, 5, 31), dt.date(2024, 5, 31), 1.0, 1, 3))
    events = spark.createDataFrame(rows, "customer_id string, invoice_id string, baseline_date date, due_date date, clearing_date date, "
                                   "promised_amount double, dunning_level int, promise_state int")
    dates = [dt.date(2022, 1, 31), dt.date(2023, 3, 1), dt.date(2023, 12, 31), dt.date(2024, 2, 29), dt.date(2024, 5, 31), dt.date(2024, 6, 1), dt.date(2021, 1, 1)]
    who = ["hot", "alone", "nobody", *[f"c{i:02d}" for i in range(60)]]
    spine = spark.createDataFrame([(w, d) for w in who for d in dates] + [("hot", dates[1])], "customer_id string, snapshot_date date")
    return events.cache(), spine.cache()


def values(df):
    out = {}
    for r in df.collect():
        assert (r.customer_id, r.snapshot_date) not in out
        out[r.customer_id, r.snapshot_date] = [None if v is None else float(v) for v in r[2:]]
    return out


@pytest.mark.parametrize("block", ["behaviour", "dunning", "promise"])
def test_equals_the_range_join(tables, block):
    events, spine = tables
    made = {"behaviour": features.behaviour_block(CFG), "dunning": features.dunning_block(CFG, "clearing_date"),
            "promise": features.promise_block(CFG, "clearing_date")}[block]
    want = features.history_on_spine(events, made, spine.distinct())
    got = features.history_in_buckets(events, made, spine)
    assert got.columns == want.columns
    a, b = values(got), values(want)
    assert a.keys() == b.keys() and len(a) > 200
    for k in a:
        assert [x is None for x in a[k]] == [x is None for x in b[k]], k
        assert np.allclose([x for x in a[k] if x is not None], [x for x in b[k] if x is not None]), k


def test_a_large_customer_is_spread_over_its_months(spark, tables):
    events, spine = tables
    got = features.history_in_buckets(events, features.behaviour_block(CFG), spine)
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "customer_id" in line]
    assert joins and all("_own" in line or "_month" in line for line in joins)
    n = events.where("clearing_date is not null").count()
    paid = events.where("clearing_date is not null")
    most = paid.groupBy("customer_id", F.trunc("clearing_date", "MM")).count().agg(F.max("count")).first()[0]
    assert most < n / 10


def test_tables_of_months_are_not_broadcast(tables):
    """Small as they look in a file, they grow with customers times months, and the driver would hold them."""
    events, spine = tables
    got = features.history_in_buckets(events, features.behaviour_block(CFG), spine)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_events_and_no_spine(tables):
    events, spine = tables
    block = features.behaviour_block(CFG)
    assert features.history_in_buckets(events.limit(0), block, spine).count() == 0
    assert features.history_in_buckets(events, block, spine.limit(0)).count() == 0
