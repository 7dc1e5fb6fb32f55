"""No rows are lost: routed scores, slice reports, profiles, and the partitioned view."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duescope import storage
from duescope.config import CORRECTED
from duescope.operators import evaluate as ev
from duescope.operators import explain, profile, score, train
from duescope.sources import view

SETTINGS = train.TrainSettings(trials_full=0, trials_small=0, n_splits=2, n_seeds=1, max_iter=2, min_features=2)
CLUSTERS = {"A": ["AA", "AB"], "B": ["BA"]}


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for i in range(600):
        x = (i * 37 % 101) / 101
        country = ("AA", "AB", "BA", "ZZ")[0 if i % 40 else 2] if i % 3 else ("AB" if i % 50 else "ZZ")
        rows.append((f"c{i}", dt.date(2024, 1, 1) + dt.timedelta(days=30 * (i % 10)), country, x, (i % 7) / 7, int(x > 0.6)))
    return storage.stored(spark.createDataFrame(
        rows, "customer_id string, snapshot_date date, country string, signal double, noise double, target int"))


def test_pools_without_a_model_keep_their_rows(spark, panel):
    models = train.train_per_cluster(panel, CLUSTERS, SETTINGS)
    assert set(models) == {"A"}  # B is too small
    alone = train.score_clusters(panel, models, CLUSTERS)
    assert alone.count() == panel.count()
    assert {r["status"]: r["n"] for r in alone.groupBy("status").agg(F.count("score").alias("n")).collect()}["unscored"] == 0
    helped = train.score_clusters(panel, models, CLUSTERS, train.train_global(panel, CLUSTERS, SETTINGS))
    assert helped.count() == panel.count() and helped.filter("score IS NULL OR predicted_class IS NULL").count() == 0
    assert {r["country"] for r in helped.filter("status = 'global'").select("country").distinct().collect()} == {"BA", "ZZ"}


def test_unknown_countries_pass_the_routing(spark):
    rows = spark.createDataFrame([("AA", 0.7), ("QQ", 0.7)], "country string, score double")
    table = spark.createDataFrame([("AA", "A", "m", 0.5)], "country string, cluster string, model_name string, threshold double")
    got = {r["country"]: (r["binary_pred"], r["predicted_class"]) for r in score.routed(rows, table).collect()}
    assert got == {"AA": (1, "Medium"), "QQ": (None, None)}


def test_slices_without_a_threshold_use_the_pooled_one(spark):
    rows = spark.createDataFrame([("AA", 1, 0.9), ("AA", 0, 0.2), ("BB", 1, 0.6), ("BB", 0, 0.1)], "country string, label int, score double")
    own = spark.createDataFrame([(ev.POOLED, 0.5), ("AA", 0.8)], "slice string, threshold double")
    got = {r["slice"]: r["threshold"] for r in ev.slice_report(rows, own, "country").collect()}
    assert got == {ev.POOLED: 0.5, "AA": 0.8, "BB": 0.5}


@pytest.mark.parametrize("platt_below", [1, 10**6])
def test_saved_models_score_alike(spark, panel, platt_below):
    from dataclasses import replace
    model = train.train_model(panel, "m", replace(SETTINGS, platt_below=platt_below))
    path = storage.new_path(spark, "model")
    train.save_model(model, path)
    loaded = train.load_model(spark, path)
    both = loaded.production.score(model.production.score(panel).withColumnRenamed("score", "was"))
    assert both.filter("NOT (score <=> was)").count() == 0
    assert loaded.production.kind == model.production.kind and loaded.thresholds.count() == model.thresholds.count()
    assert loaded.params == model.params and loaded.rows == model.rows


def test_surrogate_recovers_a_linear_score(spark, panel):
    rows = panel.withColumn("score", 0.2 + 0.5 * F.col("signal") - 0.1 * F.col("noise"))
    weights, means, r2 = explain.surrogate(rows, ["signal", "noise"])
    assert abs(weights["signal"] - 0.5) < 1e-3 and abs(weights["noise"] + 0.1) < 1e-3 and r2 > 0.999
    assert abs(means["signal"] - rows.agg(F.avg("signal")).first()[0]) < 1e-9


def test_customers_without_letters_or_promises_have_zeros(spark):
    items = spark.createDataFrame(
        [("c1", "i1", 10.0, dt.date(2024, 1, 1), dt.date(2024, 1, 2), 3, "BSAD"), ("c2", "i2", 5.0, dt.date(2024, 1, 1), None, 0, "BSID")],
        "customer_id string, invoice_id string, invoice_amount double, due_date date, clearing_date date, days_past_due int, source string")
    letters = spark.createDataFrame([("c1", dt.date(2024, 1, 1), 3), ("c9", dt.date(2024, 1, 1), 1)], "customer_id string, dunning_date date, dunning_level int")
    promises = spark.createDataFrame([("c1", 2, 7.0), ("c1", 3, 1.0)], "customer_id string, promise_state int, promised_amount double")
    master = spark.createDataFrame([("c1", "AA", "r"), ("c2", "AB", None), ("c3", None, None)], "customer_id string, country string, region string")
    got = {r["customer_id"]: r for r in profile.customer_features(items, letters, promises, master, CORRECTED(dt.date(2024, 2, 1))).collect()}
    assert set(got) == {"c1", "c2"}
    assert (got["c1"]["cust_promises"], got["c1"]["cust_kept"], got["c1"]["cust_promised_total"], got["c1"]["cust_dunning_escalations"]) == (1, 1, 8.0, 1)
    assert (got["c2"]["cust_dunning_events"], got["c2"]["cust_max_dunning_level"], got["c2"]["cust_promised_total"]) == (0, 0, 0.0)


def test_mix_shares_add_up_with_and_without_a_limit(spark):
    rows = spark.createDataFrame([("AA", "x"), ("AA", "y"), ("AA", None), ("BB", "z")], "country string, segment string")
    for levels in (None, 1):
        got = profile.category_mix(rows, "segment", levels=levels).groupBy("country").agg(F.sum("share").alias("s")).collect()
        assert all(abs(r["s"] - 1) < 1e-12 for r in got)


def test_constant_columns_have_no_correlation(spark):
    from duescope.operators import diagnostics
    rows = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in diagnostics.correlation_pairs(rows, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and abs(got["a", "b"] - 1) < 1e-12 and got["a", "c"] is None


def test_partitioned_view_is_pruned(spark, tmp_path):
    from duescope.plans import fixtures as fx
    from duescope.plans.q_features import CFG
    path = str(tmp_path / "view")
    view.store_clean(fx.raw_view(spark, "/root/testdata/sf0.001"), CFG, path)
    rows = view.clean_items(spark, path, CFG, "train", ["CD"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "country" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows.select("country").distinct().collect()[0][0] == "CD"


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())


def test_release_deletes_what_was_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda session: tmp_path.as_uri())
    assert storage.stored(spark.range(3)).count() == 3
    assert list(tmp_path.iterdir())
    storage.release(spark)
    assert not list(tmp_path.iterdir())
