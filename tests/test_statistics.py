"""Distributed order statistics, metrics and splits against brute force in numpy."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duescope.operators import evaluate as ev
from duescope.operators import explain, profile, score, similarity, splits
from duescope.operators.ordered import exact_quantiles, running_totals
from duescope.functions import wording


def skewed(n=3000, seed=3):
    """Two thirds of the rows in one group, most of them with near-equal scores."""
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.66, "hot", rng.choice(list("abcde"), n))
    value = np.where(group == "hot", 0.5 + rng.random(n) * 1e-4, rng.integers(0, 20, n) / 20)
    return pd.DataFrame({"id": np.arange(n), "group": group, "score": value,
                         "label": (rng.random(n) < value).astype(int)})


def test_running_totals(spark):
    pdf = skewed().groupby(["group", "score"], as_index=False).size().rename(columns={"size": "n"})
    got = running_totals(spark.createDataFrame(pdf), ["group"], "score", ["n"], slices=7).toPandas()
    want = pdf.sort_values("score").assign(cum=lambda d: d.groupby("group")["n"].cumsum())
    merged = want.merge(got, on=["group", "score"])
    assert len(merged) == len(pdf) and (merged["cum"] == merged["cum_n"]).all()


@pytest.mark.parametrize("q", [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0])
def test_exact_quantiles(spark, q):
    pdf = skewed()
    got = exact_quantiles(spark.createDataFrame(pdf), ["group"], "score", {"v": q}, 8).toPandas()
    want = pdf.groupby("group")["score"].quantile(q)
    assert np.allclose(got.set_index("group")["v"].sort_index(), want.sort_index())


def brute_ap(label, prob):
    total, best = label.sum(), 0.0
    for t in np.unique(prob)[::-1]:
        at, hit = prob == t, prob >= t
        best += label[at].sum() / total * label[hit].sum() / hit.sum()
    return best


def brute_auc(label, prob):
    p, n = prob[label == 1], prob[label == 0]
    return ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))


def test_ranking_metrics_and_thresholds(spark):
    pdf = skewed(1200)
    points = ev.score_points(spark.createDataFrame(pdf), ["group"])
    got = ev.ranking_metrics(points, ["group"]).join(
        ev.threshold_at_recall(points, ["group"], 0.8), "group").toPandas().set_index("group")
    for g, part in pdf.groupby("group"):
        y, s = part["label"].to_numpy(), part["score"].to_numpy()
        assert np.isclose(got.loc[g, "pr_auc"], brute_ap(y, s))
        assert np.isclose(got.loc[g, "roc_auc"], brute_auc(y, s))
        options = [((y[s >= t].sum() / (s >= t).sum()), -t) for t in np.unique(s)
                   if y[s >= t].sum() / y.sum() >= 0.8]
        assert np.isclose(got.loc[g, "threshold"], -max(options)[1])


def test_single_class_group_has_no_ranking(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 1, 0.4)], "g string, label int, score double")
    row = ev.ranking_metrics(ev.score_points(df, ["g"]), ["g"]).first()
    assert row["pr_auc"] is None and row["roc_auc"] is None


def test_grid_is_exact_on_its_thresholds(spark):
    grid = ev.Grid(0.05, 0.7, 200)
    at = [grid.start + i * grid.step for i in range(200)]
    pdf = pd.DataFrame({"score": at + [0.0, 0.99, 0.3], "label": [1, 0] * 101 + [1]})
    got = ev.threshold_curve(spark.createDataFrame(pdf), grid).orderBy("step").toPandas()
    for i in (0, 1, 57, 198, 199):
        hit = pdf[pdf["score"] >= at[i]]
        assert got.loc[i, "tp"] == hit["label"].sum()
        assert got.loc[i, "fp"] == (1 - hit["label"]).sum()


def test_top_share_counts_ties_in_proportion(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (1, 0.1)], "label int, score double")
    row = ev.top_share_recall(df, [0.4]).first()
    assert row["n_top"] == 2 and np.isclose(row["recall"], (1 + 1 / 3) / 3)


def test_tertiles_collapse(spark):
    rows = [("one", 0.5)] * 6 + [("two", 0.1)] * 5 + [("two", 0.9)] * 5 + [
        ("spread", i / 9) for i in range(10)] + [("heavy", 0.1)] * 8 + [("heavy", 0.7), ("heavy", 0.9)]
    df = spark.createDataFrame(rows, "country string, score double")
    got = score.with_tertiles(df, "country", "score").groupBy("country", "risk_band").count()
    bands = {(r[0], r[1]): r[2] for r in got.collect()}
    assert bands[("one", "Low")] == 6
    assert bands[("spread", "Low")] == 4 and bands[("spread", "High")] == 3
    assert {b for c, b in bands if c == "heavy"} == {"Low"}
    assert {b for c, b in bands if c == "two"} == {"Low"}


def panel(spark, dates=13, per=10):
    rows = [(f"c{i}", dt.date(2024, 1, 1) + dt.timedelta(days=30 * d), "A" if i % 2 else "B",
             (i + d) % 2) for d in range(dates) for i in range(per)]
    return spark.createDataFrame(
        rows, "customer_id string, snapshot_date date, country string, target int")


def test_country_profile_counts_customers_apart(spark):
    """Null countries and customers count as before; nothing but the count is kept for each customer."""
    day, rows = dt.date(2024, 1, 1), []
    for i in range(60):
        rows.append((None if i % 4 == 0 else "AA", None if i % 5 == 0 else f"c{i % 7}", i, 1, 1, 10.0 * i, 1.0, 0, 5.0, 9, 30, 3, day, day, None, None))
    view = spark.createDataFrame(rows, "country string, customer_id string, days_past_due int, dunning_level int, dunning_count int, invoice_amount double, "
                                 "open_amount double, number_of_disputes int, credit_limit double, customer_tenure_days int, net_payment_days int, "
                                 "fin_p2p_state int, clearing_date date, due_date date, fin_promised_amt double, dispute_create_date date")
    out = profile.country_profile(view)
    got = {r.country: (r.n_invoices, r.n_customers, r.dpd_mean, r.dpd_median) for r in out.collect()}
    assert list(out.columns)[:3] == ["country", "n_invoices", "n_customers"]
    for name in (None, "AA"):
        mine = sorted(r[2] for r in rows if r[0] == name)
        known = {r[1] for r in rows if r[0] == name} - {None}
        assert got[name] == (len(mine), len(known), sum(mine) / len(mine), mine[(len(mine) - 1) // 2])
    kept = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "percentile_approx" in line]
    assert kept and not any("customer_id" in line for line in kept)


def test_walk_forward_never_looks_ahead(spark):
    folds = splits.walk_forward(panel(spark), n_splits=3, gap_days=30)
    edges = folds.groupBy("fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("snapshot_date"))).alias("t"),
        F.min(F.when(F.col("role") == "val", F.col("snapshot_date"))).alias("v")).collect()
    assert len(edges) == 3
    assert all((e["v"] - e["t"]).days >= 30 for e in edges)


def test_last_rows_split(spark):
    df = panel(spark)
    tie = F.regexp_replace("customer_id", "c", "").cast("bigint")
    val = splits.last_rows_split(df, tie, 0.2, 5).filter("role = 'val'").toPandas()
    assert len(val) == 26
    assert val["snapshot_date"].value_counts().to_dict()[val["snapshot_date"].min()] == 6
    small = df.limit(7)
    assert splits.last_rows_split(small, tie, 0.2, 20).filter("role = 'val'").count() == 7


def test_single_class_validation_falls_back_to_rows(spark):
    df = panel(spark).withColumn(
        "target", F.when(F.col("snapshot_date") > dt.date(2024, 11, 1), 0).otherwise(F.col("target")))
    tie = F.regexp_replace("customer_id", "c", "").cast("bigint")
    out = splits.guarded_val_split(df, tie, 0.15)
    assert out.count() == df.count()
    assert out.filter("role = 'val'").count() == 20


def test_rewritten_drivers(spark):
    df = spark.createDataFrame([
        ("max_dpd (145.0) increased risk. | pct_30_plus (0.45) increased risk. | kept_ratio (0.9) reduced risk.", "High"),
        ("total_outstanding (48,750.00) increased risk.", "Medium"),
        ("High broken promise ratio (0.62) increased risk.", "High"),
        ("max_dpd (145.0) increased risk.", "Low"),
        ("", "High"), (None, "High")], "t string, c string")
    got = [r[0] for r in df.select(explain.rewritten(F.col("t"), F.col("c"))).collect()]
    assert got == [
        "Worst overdue invoice: 145 days late — increased risk | "
        "Share of debt 30+ days overdue: 45% — increased risk",
        "Total unpaid balance: 48,750 EUR — increased risk",
        "High broken promise ratio (0.62) increased risk",
        "max_dpd (145.0) increased risk.", "", ""]


def test_sentences(spark):
    df = spark.createDataFrame(
        [("on_time_ratio_60d", 0.255, -1.0), ("total_outstanding", 1234567.5, 2.0),
         ("max_dpd", 12.9, 1.0), ("avg_dunning_level", 2.25, 1.0),
         ("promise_activity_flag", 0.0, 1.0), ("some_new_feature", 3.0, -1.0)],
        "f string, v double, c double")
    got = [r[0] for r in df.select(
        explain.sentence(F.col("f"), F.col("v"), F.col("c"))).collect()]
    assert got == [
        "In the last 60 days 26% of payments were on time, which reduced risk.",
        "Total unpaid balance of 1,234,568 EUR increased risk.",
        "Worst invoice is 12 days overdue, which increased risk.",
        "Average dunning severity is 2.2, which increased risk.",
        "Customer does not use payment promises, which increased risk.",
        "Some new feature value of 3.0 reduced risk."]


def test_note_inputs_for_excluded_customers(spark):
    df = spark.createDataFrame([("a (1) increased risk.", "DNT"), (None, "High"), ("x", "Odd")],
                               "collector_explanations string, predicted_class string")
    rows = explain.note_inputs(df).collect()
    assert rows[0]["fixed_note"] == wording.DNT_SUMMARY and rows[0]["note_drivers"] is None
    assert rows[1]["class_meaning"] is None
    assert rows[2]["class_meaning"] == wording.UNKNOWN_CLASS


def test_silhouette_of_two_clear_clusters(spark):
    values = {"a": 0.0, "b": 0.1, "c": 5.0, "d": 5.2, "lone": 20.0}
    zs = spark.createDataFrame([(k, "f", v, v) for k, v in values.items()],
                               "country string, feature string, value double, z double")
    labels = spark.createDataFrame(
        [("a", 0), ("b", 0), ("c", 1), ("d", 1), ("lone", 2)], "country string, cluster int")
    got = {r["country"]: r["silhouette"]
           for r in similarity.silhouettes(similarity.pairwise(zs), labels).collect()}
    assert got["lone"] == 0.0 and min(got[c] for c in "abcd") > 0.9
