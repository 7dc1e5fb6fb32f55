"""Model training on a small synthetic panel with a known signal."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from duescope.operators import train

SETTINGS = train.TrainSettings(
    trials_full=0, trials_small=0, n_splits=2, n_seeds=2, max_iter=3, min_features=2)


@pytest.fixture(scope="module")
def panel(spark):
    rng, rows = random.Random(5), []
    for d in range(10):
        for i in range(60):
            x, noise = rng.random(), rng.random()
            rows.append((f"c{i}", dt.date(2024, 1, 1) + dt.timedelta(days=30 * d),
                         "AA" if i % 2 else "AB", x, noise, int(x + 0.2 * noise > 0.6)))
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date, country string, "
                                 "signal double, noise double, target int").cache()


def test_train_model_ranks_the_signal(spark, panel):
    model = train.train_model(panel, "m", SETTINGS)
    pooled = model.report.filter("slice = 'POOLED'").first()
    assert pooled["roc_auc"] > 0.8 and pooled["recall"] > 0.5
    scored = model.production.score(panel)
    assert scored.count() == panel.count()
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0
    assert {r["slice"] for r in model.thresholds.collect()} == {"POOLED", "AA", "AB"}


def test_too_small_pools_are_skipped(spark, panel):
    assert train.train_model(panel.limit(50), "tiny", SETTINGS) is None


def test_rescue_and_selection(spark, panel):
    dev = panel.withColumn("role", F.when(
        F.col("snapshot_date") > dt.date(2024, 8, 1), "val").otherwise("train"))
    blocked = replace(train.CONSERVATIVE, max_iter=2, min_rows_per_node=10**9)
    names = ["signal", "noise"]
    model, used = train.fit_selector(dev, names, blocked, SETTINGS)
    assert used.min_rows_per_node == 1 and not train.never_split(model)
    assert train.selected_features(model, names, 0.0, 1) == names
    assert train.selected_features(model, names, 0.9, 1) == ["signal"]
    assert train.selected_features(model, names, 0.9, 2) == names


def test_calibration_kind_follows_positives(spark, panel):
    weighted = train.weighted(panel, train.CONSERVATIVE)
    params = replace(train.CONSERVATIVE, max_iter=2)
    base = train.fit_ensemble(weighted, ["signal", "noise"], params, 1)
    few = train.calibrated(base, panel, platt_below=10**6)
    many = train.calibrated(base, panel, platt_below=1)
    assert (few.kind, many.kind) == ("platt", "isotonic")
    for fitted in (few, many):
        spread = fitted.score(panel).agg(F.min("score"), F.max("score")).first()
        assert 0 <= spread[0] < spread[1] <= 1


def test_search_prefers_the_better_candidate(spark, panel):
    from duescope.operators import splits

    folds = splits.walk_forward(panel, 2, 30)
    tried = [replace(train.CONSERVATIVE, max_iter=1, min_rows_per_node=10**9),
             replace(train.CONSERVATIVE, max_iter=2)]
    assert train.search(folds, ["signal", "noise"], tried, 0.5).first()["candidate"] == 1


def test_candidates_are_repeatable():
    assert train.candidates("small", 3, 5) == train.candidates("small", 3, 5)
    assert all(p.max_depth <= 3 for p in train.candidates("small", 20, 5))


def test_rungs_halve_candidates_and_double_rounds():
    assert train.rungs(8, 16) == [(8, 2), (4, 4), (2, 8), (1, 16)]
    assert train.rungs(1, 500) == [(1, 500)]
    full = train.rungs(120, 500)
    assert [n for n, _ in full] == [120, 60, 30, 15, 8, 4, 2, 1] and full[-1][1] == 500
    assert sum(n * r for n, r in full) < 12 * 500


def test_halving_keeps_the_better_half(spark, panel):
    from duescope.operators import splits

    bounds = splits.usable_bounds(panel, 2, 30)
    kept = splits.walk_forward(panel, 2, 30).select("fold").distinct().count()
    assert len(bounds) == kept == 2
    blind = replace(train.CONSERVATIVE, max_iter=4, min_rows_per_node=10**9)
    tried = [blind, replace(train.CONSERVATIVE, max_iter=4), blind]
    found = train.halving(panel, bounds, ["signal", "noise"], tried, 0.5).collect()
    assert [(r.rung, r.rounds) for r in found] == [(0, 2)] * 3 + [(1, 2)] * 2 + [(2, 4)]
    assert found[-1].candidate == 1 and sum(r.survives for r in found if r.rung == 0) == 2


def test_composite_objective_by_hand(spark):
    """Average precision, F2 at one half, and recall in the best fifth, counted out."""
    scores = [0.95, 0.9, 0.8, 0.7, 0.6, 0.4, 0.3, 0.2, 0.1, 0.05]
    labels = [1, 0, 1, 1, 0, 1, 0, 0, 0, 0]
    rows = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    precision = (1 / 1 + 2 / 3 + 3 / 4 + 4 / 6) / 4
    p, r = 3 / 5, 3 / 4
    f2, top = 5 * p * r / (4 * p + r), 1 / 4
    assert abs(train.composite(rows) - (0.5 * precision + 0.3 * f2 + 0.2 * top)) < 1e-9
    assert train.composite(rows, None) != train.composite(rows)


def test_macro_precision_of_many_tasks_at_once(spark):
    """As one by one: a task with one class in every country has the pooled value, one of a single class none."""
    from duescope.operators import evaluate as ev

    rows = [(t, c, int((i * 7 + t) % 3 == 0), ((i * 13 + t * 5) % 17) / 17) for t in (0, 1) for c in ("AA", "AB", None) for i in range(20)]
    rows += [(2, "AA", 1, 0.9), (2, "AA", 1, 0.2), (2, "AB", 0, 0.5), (3, "AA", 1, 0.5), (4, None, 1, 0.7), (4, None, 0, 0.8)]
    scored = spark.createDataFrame(rows, "task int, country string, label int, score double")
    got = {r["task"]: r["score"] for r in ev.macro_average_precision(scored, "country", "task").collect()}
    want = {t: train.macro_precision(scored.where(F.col("task") == t)) for t in range(5)}
    assert set(got) == set(want) and got[3] is want[3] is None
    assert all(abs(got[t] - want[t]) < 1e-12 for t in (0, 1, 2, 4))


def test_a_rung_is_evaluated_in_one_go(spark, panel, monkeypatch):
    from duescope.operators import evaluate as ev
    from duescope.operators import splits

    calls, exact = [], ev.macro_average_precision
    monkeypatch.setattr(ev, "macro_average_precision", lambda *a: calls.append(a) or exact(*a))
    tried = [replace(train.CONSERVATIVE, max_iter=1, max_depth=1), replace(train.CONSERVATIVE, max_iter=1)]
    bounds = splits.usable_bounds(panel, 2, 30)[:1]
    together = train.halving(panel, bounds, ["signal", "noise"], tried, 0.5).drop("survives").collect()
    assert len(calls) == 2  # one for each rung; there was one for each fit
    alone = train.halving(panel, bounds, ["signal", "noise"], tried, 0.5, objective=lambda s: train.macro_precision(s)).drop("survives").collect()
    assert [[round(v, 9) for v in r] for r in together] == [[round(v, 9) for v in r] for r in alone]


def test_validation_stops_where_the_error_rises(spark, panel):
    """Rounds that gain under 1 % each go on; Spark's tolerance left one tree of them."""
    dev = panel.withColumn("role", F.when(F.col("snapshot_date") > dt.date(2024, 8, 1), "val").otherwise("train"))
    slow = replace(train.CONSERVATIVE, max_iter=6, step_size=0.005)
    model = train.fit_trees(train.weighted(dev, slow), ["signal", "noise"], slow, role="role")
    assert model.getNumTrees == 6


def test_m12_trains_at_the_default_budget_without_a_search(spark, monkeypatch):
    from duescope.plans import load_all
    from duescope.plans.registry import QUERIES

    load_all()
    from duescope.plans import q_train

    seen = []
    monkeypatch.setattr(q_train, "panel", lambda *a: None)
    monkeypatch.setattr(train, "train_model", lambda rows, name, settings: seen.append(settings) or _model(spark))
    QUERIES["m12_pooled_fixed_parameters"].build(spark, "unread")
    assert seen == [replace(train.TrainSettings(), trials_full=0, trials_small=0)]


def _model(spark):
    return train.TrainedModel("m", None, None, train.CONSERVATIVE, None, spark.range(1), False, 0)


def test_x02_x11_trains_at_the_default_budget(spark, monkeypatch):
    from duescope.plans import load_all
    from duescope.plans.registry import QUERIES

    load_all()
    from duescope.plans import q_train

    class Seen(Exception):
        pass

    def both(models, overall, _):
        models(), overall()
        raise Seen

    def told(rows, clusters, settings):
        seen.append(settings)

    seen = []
    monkeypatch.setattr(q_train, "panel", lambda *a: None)
    monkeypatch.setattr(train, "at_once", both)
    monkeypatch.setattr(train, "train_per_cluster", told)
    monkeypatch.setattr(train, "train_global", told)
    with pytest.raises(Seen):
        QUERIES["x02_x11_routed_scores_with_output_columns"].build(spark, "unread")
    assert seen == [train.TrainSettings()] * 2
