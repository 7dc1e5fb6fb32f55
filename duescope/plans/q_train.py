"""Models trained on the whole panel, with small budgets, and their scores and reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from duescope.operators import evaluate as ev
from duescope.operators import contributions, explain, isotonic, score, splits, train
from duescope.plans import fixtures as fx
from duescope.plans import sqlviews as sv
from duescope.plans.q_features import labelled, serving, training
from duescope.plans.registry import query
from duescope.storage import new_path, stored

# The defaults of TrainSettings search 120 or 30 candidates of up to 500 rounds, as x02_x11 does; the
# other registered searches try two of up to eight rounds. All use all their rows.
SETTINGS = train.TrainSettings(trials_full=2, trials_small=2, n_splits=2, n_seeds=2, max_iter=8)
CHECKED = replace(SETTINGS, n_seeds=1)  # where only rows and sums of the scores are checked
FIXED = train.TrainSettings(trials_full=0, trials_small=0)  # the defaults, without their search
PARAMS = train.TreeParams(max_iter=8, max_depth=3)
CLUSTERS = {a: [a + b for b in "ABCDE"] for a in "ABCDE"}
_IDS = ["customer_id", "snapshot_date", "country"]


def panel(spark, path):
    """Exposure panel with its label: the feature set of the smaller trainer."""
    return stored(labelled(spark, path))


def clustered(spark, path):
    return panel(spark, path).withColumn("cluster", F.substring("country", 1, 1))


def split_and_fit(spark, path):
    rows = splits.quantile_split(panel(spark, path), told=True)
    dev = rows.filter(F.col("role") != "test")
    features = train.feature_list(rows)
    return rows, dev, features


@query("m01_feature_list", uses="train", sql=f"""
SELECT n_rows, feature, nonzero_rows FROM (UNPIVOT (SELECT (SELECT count(*) FROM train) AS n_rows,
  {', '.join(f'count(*) FILTER ({c} <> 0) AS {c}' for c in sv.NUMERIC_FEATURES)} FROM train)
  ON {', '.join(sv.NUMERIC_FEATURES)} INTO NAME feature VALUE nonzero_rows)""")
def _(spark, path):
    rows = training(spark, path)
    names = train.feature_list(rows)
    return rows.agg(F.count("*").alias("n_rows"), *[
        F.count_if(F.col(c) != 0).alias(c) for c in names]).unpivot(
        ["n_rows"], names, "feature", "nonzero_rows")


@query("m02_boosted_trees")
def _(spark, path):
    rows, dev, features = split_and_fit(spark, path)
    model = train.fit_ensemble(train.weighted(dev, PARAMS), features, PARAMS, 1, role="role")
    scored = model.raw(rows.filter(F.col("role") == "test")).withColumnRenamed("target", "label")
    return ev.operating_report(stored(scored.select("label", "score")), [], F.lit(0.5))


@query("m03_per_cluster_training")
def _(spark, path):
    chosen = replace(SETTINGS, n_seeds=1)
    models = train.train_per_cluster(panel(spark, path), CLUSTERS, chosen)
    out = None
    for m in models.values():
        out = m.report if out is None else out.unionByName(m.report)
    return out


@query("m04_global_training")
def _(spark, path):
    return train.train_global(panel(spark, path), CLUSTERS, SETTINGS).report


@query("m05_size_gate", uses="lab", sql="""
SELECT cluster, n, positives, dates, CASE WHEN n < 100 OR positives < 10 THEN 'skip' WHEN dates < 3 THEN 'fixed'
  WHEN n >= 1750 AND positives >= 100 THEN 'full' ELSE 'small' END AS mode
FROM (SELECT substr(country, 1, 1) AS cluster, count(*) AS n, count(*) FILTER (target = 1) AS positives,
  count(DISTINCT snapshot_date) AS dates FROM lab GROUP BY 1)""")
def _(spark, path):
    rows = labelled(spark, path).withColumn("cluster", F.substring("country", 1, 1))
    return train.size_gate(rows, replace(SETTINGS, full_rows=1750))


@query("m06_search_objective")
def _(spark, path):
    rows = panel(spark, path)
    folds = splits.walk_forward(rows, 2, 30)
    tried = train.candidates("small", 2, max_iter=3)
    return train.search(folds, train.feature_list(rows), tried, penalty=1.0)


@query("m06_successive_halving", uses="lab", sql="""
SELECT rung, rounds, tried, 2 AS folds, survive, 0 AS better_dropped, 0 AS beyond_penalty, 1 AS has_rows
FROM (VALUES (0, 2, 8, 4), (1, 4, 4, 2), (2, 8, 2, 1), (3, 16, 1, 1)) t(rung, rounds, tried, survive)
WHERE (SELECT count(*) FROM lab) > 0""")
def _(spark, path):
    """Eight candidates, half of them with twice the rounds each time; none is dropped for a worse one."""
    rows = panel(spark, path)
    bounds = splits.usable_bounds(rows, 2, 30)
    found = stored(train.halving(rows, bounds, train.feature_list(rows), train.candidates("small", 8, max_iter=16), penalty=1.0))
    keep = F.col("survives")
    least, most = F.min(F.when(keep, F.col("objective"))), F.max(F.when(~keep, F.col("objective")))
    return found.groupBy("rung").agg(
        F.max("rounds").alias("rounds"), F.count("*").cast("int").alias("tried"), F.max("folds").alias("folds"), F.count_if(keep).cast("int").alias("survive"),
        F.coalesce((most > least).cast("int"), F.lit(0)).alias("better_dropped"),
        F.count_if(F.abs(F.col("objective") - (F.col("mean") - F.col("spread"))) > 1e-9).cast("int").alias("beyond_penalty"),
        F.lit(int(rows.limit(1).count())).alias("has_rows"))


@query("m07_feature_selection")
def _(spark, path):
    _rows, dev, features = split_and_fit(spark, path)
    model, _ = train.fit_selector(dev, features, PARAMS, SETTINGS)
    kept = set(train.selected_features(model, features, 0.01, 5))
    return train.Ensemble(features, [model]).importance(spark).withColumn(
        "kept", F.col("feature").isin(sorted(kept)).cast("int"))


@query("m08_degenerate_rescue")
def _(spark, path):
    _rows, dev, features = split_and_fit(spark, path)
    blocked = replace(PARAMS, max_iter=2, min_rows_per_node=10**9)
    model, used = train.fit_selector(dev, features, blocked, SETTINGS)
    return train.Ensemble(features, [model]).importance(spark).withColumn(
        "rescued", F.lit(int(used.min_rows_per_node == train.RESCUE.min_rows_per_node)))


@query("m09_seed_ensemble")
def _(spark, path):
    rows, dev, features = split_and_fit(spark, path)
    model = train.fit_ensemble(train.weighted(dev, PARAMS), features, PARAMS, 2, role="role")
    return model.raw(rows.filter(F.col("role") == "test")).select(*_IDS, "target", "score")


@query("m10_calibration")
def _(spark, path):
    rows, dev, features = split_and_fit(spark, path)
    model = train.fit_ensemble(train.weighted(dev, PARAMS), features, PARAMS, 1, role="role")
    fitted = train.calibrated(model, rows.filter(F.col("role") == "val"))
    scored = fitted.score(rows.filter(F.col("role") == "test")).withColumnRenamed(
        "target", "label")
    return ev.calibration_bins(scored).withColumn("calibration", F.lit(fitted.kind))


@query("m10_isotonic_steps", uses="lab", spec="mean_target:9 mean_value:9", sql="""
SELECT count(*) AS n, avg(target) AS mean_target, avg(target) AS mean_value, 0 AS falling, 0 AS uncovered FROM lab""")
def _(spark, path):
    """A rising fit of the label on the overdue days keeps the label's mean, never falls, and has a
    step for every row."""
    rows = stored(panel(spark, path).select(F.col("avg_dpd").cast("double").alias("score"), "target").withColumn("w", F.lit(1.0)))
    found = isotonic.steps(rows)
    kept = F.transform(F.array_sort(F.collect_list(F.struct("lo", "value"))), lambda s: s["value"])
    about = found.agg(F.sum("weight").alias("covered"), (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("mean_value"),
                      (kept != F.array_sort(kept)).cast("int").alias("falling"))
    n = F.count("*")
    return about.select(
        rows.agg(n).scalar().alias("n"), rows.agg(F.avg(F.col("target").cast("double"))).scalar().alias("mean_target"), "mean_value", "falling",
        (rows.agg(n).scalar() - F.col("covered")).cast("long").alias("uncovered"))


@query("m11_production_refit")
def _(spark, path):
    rows, dev, features = split_and_fit(spark, path)
    stopped = train.fit_ensemble(train.weighted(dev, PARAMS), features, PARAMS, 1, role="role")
    locked = replace(PARAMS, max_iter=max(1, stopped.trees))
    refit = train.fit_ensemble(train.weighted(rows, locked), features, locked, 1)
    return refit.raw(rows).groupBy("country").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean_score"),
        F.avg(F.col("target").cast("double")).alias("positive_rate")).withColumn(
        "trees", F.lit(refit.trees))


_ROWS_BY_COUNTRY = """
SELECT country, count(*) AS n, count(*) FILTER (target = 1) AS positives, 0 AS differing, 0 AS out_of_range
FROM lab GROUP BY country"""


@query("m11_saved_model_scores_alike", uses="lab", sql=_ROWS_BY_COUNTRY)
def _(spark, path):
    """A model saved and loaded, calibrator included, gives the scores it gave."""
    rows = panel(spark, path)
    model = train.train_model(rows, "pooled", replace(SETTINGS, n_seeds=1))
    target = new_path(spark, "model")
    train.save_model(model, target)
    loaded = train.load_model(spark, target)
    both = loaded.production.score(model.production.score(rows).withColumnRenamed("score", "saved"))
    return both.groupBy("country").agg(
        F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("positives"),
        F.count_if(~F.col("score").eqNullSafe(F.col("saved"))).alias("differing"),
        F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("out_of_range"))


@query("m13_routing_rows_from_training", uses="lab", sql="""
SELECT c.country, substr(c.country, 1, 1) AS cluster, 'risk_' || substr(c.country, 1, 1) AS model_name, 1 AS has_thresholds,
  n AS trained_rows, 1 AS n_seeds, '2001-08-01' AS refresh_date
FROM (SELECT chr(CAST(65 + a AS INTEGER)) || chr(CAST(65 + b AS INTEGER)) AS country FROM range(5) x(a), range(5) y(b)) c
JOIN (SELECT substr(country, 1, 1) AS cluster, count(*) AS n, count(*) FILTER (target = 1) AS p FROM lab GROUP BY 1) s
  ON s.cluster = substr(c.country, 1, 1) WHERE n >= 100 AND p >= 10""")
def _(spark, path):
    models = train.train_per_cluster(panel(spark, path), CLUSTERS, replace(SETTINGS, n_seeds=1))
    rows = train.routing_rows(models, CLUSTERS, fx.ANCHOR)
    return rows.select(
        "country", "cluster", "model_name",
        (F.col("threshold").isNotNull() & F.col("cluster_threshold").isNotNull()).cast("int").alias("has_thresholds"),
        "trained_rows", "n_seeds", "refresh_date")


@query("m12_pooled_fixed_parameters")
def _(spark, path):
    """No search, as the name says; validation decides on up to 500 rounds of three seeds."""
    return train.train_model(panel(spark, path), "pooled", FIXED).report


@query("w12_leave_one_country_out_fit")
def _(spark, path):
    rows = clustered(spark, path)
    scored = stored(train.leave_one_out_scores(rows, train.feature_list(rows), PARAMS))
    return ev.ranking_metrics(ev.score_points(scored, ["country"]), ["country"])


@query("x01_score_single_model")
def _(spark, path):
    rows = panel(spark, path)
    model = train.train_model(rows, "pooled", replace(SETTINGS, n_seeds=1))
    threshold = model.thresholds.filter(F.col("slice") == ev.POOLED).select("threshold").scalar()
    today = stored(serving(spark, path, only_exposed=True))
    scored = score.fixed_class(model.production.score(today), threshold)
    return scored.select(*_IDS, "score", "threshold_used", "binary_pred", "predicted_class")


def routed_scores(spark, path, settings=train.TrainSettings()):
    """Serving rows scored by the model of their cluster; one cluster is left to the global model.
    The models are searched and trained at the default budget unless `settings` says otherwise."""
    rows = panel(spark, path)
    trained = {k: v for k, v in CLUSTERS.items() if k != "E"}
    models, overall, today = train.at_once(
        lambda: train.train_per_cluster(rows, trained, settings), lambda: train.train_global(rows, CLUSTERS, settings),
        lambda: stored(serving(spark, path, only_exposed=True)))
    scored = train.score_clusters(today, models, CLUSTERS, overall, explained=True)
    return stored(scored.withColumnRenamed("score", "risk_score")), train.feature_list(rows)


def told_scores(spark, path, settings=train.TrainSettings()):
    """The output table, with the drivers of the model that scored each row."""
    scored, features = routed_scores(spark, path, settings)
    told = explain.explanations(explain.top_drivers(scored))
    banded = score.with_tertiles(told.drop("drivers", "base_value"), "country", "risk_score")
    return score.output_table(banded.withColumn("model_features", F.lit(", ".join(features))))


@query("x02_x11_routed_scores_with_output_columns")
def _(spark, path):
    return told_scores(spark, path)


@query("x11_output_rows_complete", uses="serve", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, country, substr(country, 1, 1) AS cluster, 1 AS scored, 1 AS banded, 1 AS explained
FROM serve WHERE total_outstanding > 0""")
def _(spark, path):
    """One row per serving row: scored between 0 and 1, banded both ways, and explained."""
    out = told_scores(spark, path, CHECKED)
    texts = ("top_risk_drivers", "top_risk_driver", "collector_explanations")
    return out.select(
        *_IDS[:2], "country", "cluster", F.coalesce(F.col("risk_score").between(0, 1), F.lit(False)).cast("int").alias("scored"),
        F.coalesce(F.col("predicted_class").isin("High", "Medium", "Low") & F.col("risk_band").isNotNull(), F.lit(False)).cast("int").alias("banded"),
        F.coalesce(sum((F.length(c) > 0).cast("int") for c in texts) == len(texts), F.lit(False)).cast("int").alias("explained"))


@query("x04_tree_contributions_add_up", uses="serve", sql="""
SELECT country, CASE WHEN country LIKE 'E%' THEN 'global' ELSE 'cluster' END AS status, count(*) AS n_rows, 0 AS without, 0 AS off
FROM serve WHERE total_outstanding > 0 GROUP BY 1, 2""")
def _(spark, path):
    """Base value and contributions make the log-odds of the model that scored the row. The models
    have one seed and a calibrator that rises with the score, so equal log-odds have equal scores."""
    scored, _ = routed_scores(spark, path, CHECKED)
    added = F.aggregate("drivers", F.col("base_value"), lambda s, d: s + d["contribution"])
    told = scored.withColumn("odds", F.round(added, 6))
    same = told.groupBy("cluster", "status", "country", "odds").agg(F.count("*").alias("n"), F.count_if(added.isNull()).alias("without"),
                                                                F.min("risk_score").alias("lo"), F.max("risk_score").alias("hi"))
    return same.groupBy("country", "status").agg(
        F.sum("n").alias("n_rows"), F.sum("without").alias("without"), F.count_if(F.col("hi") - F.col("lo") > 1e-6).alias("off"))


@query("x02_every_row_is_scored", uses="serve", sql="""
SELECT country, CASE WHEN country LIKE 'E%' THEN 'global' ELSE 'cluster' END AS status, count(*) AS n_rows,
  0 AS unscored, 0 AS out_of_range, 0 AS misclassified
FROM serve WHERE total_outstanding > 0 GROUP BY 1, 2""")
def _(spark, path):
    scored, _ = routed_scores(spark, path, CHECKED)
    s, at = F.col("risk_score"), F.col("threshold_used")
    return scored.groupBy("country", "status").agg(
        F.count("*").alias("n_rows"), F.count_if(s.isNull() | at.isNull()).alias("unscored"),
        F.count_if(~F.coalesce(s.between(0, 1), F.lit(False))).alias("out_of_range"),
        F.count_if((F.col("binary_pred") == 1) != (s >= at)).alias("misclassified"))


@query("x03_global_model_scores", uses="serve", sql="""
SELECT country, count(*) AS n_rows, 0 AS out_of_range, 1 AS thresholds FROM serve WHERE total_outstanding > 0 GROUP BY 1""")
def _(spark, path):
    """Serving rows scored by the saved and loaded global model at its pooled threshold."""
    model = train.train_global(panel(spark, path), CLUSTERS, replace(SETTINGS, n_seeds=1))
    target = new_path(spark, "model")
    train.save_model(model, target)
    scored = train.score_clusters(serving(spark, path, only_exposed=True), {}, CLUSTERS, train.load_model(spark, target))
    return scored.groupBy("country").agg(
        F.count("*").alias("n_rows"), F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("out_of_range"),
        F.count_distinct("threshold_used").alias("thresholds"))


def boosted(spark, path):
    """The labelled panel and two seeds of trees fitted on it."""
    rows, _dev, features = split_and_fit(spark, path)
    return rows, train.fit_ensemble(train.weighted(rows, PARAMS), features, PARAMS, 2)


@query("x04_tree_contributions", uses="lab", sql="SELECT country, count(*) AS n_rows, 0 AS off FROM lab GROUP BY country")
def _(spark, path):
    """Base value and contributions make the log-odds the models give, for every row within 1e-6."""
    rows, model = boosted(spark, path)
    told = contributions.with_log_odds(contributions.with_contributions(rows, model), model)
    added = F.aggregate("drivers", F.col("base_value"), lambda s, d: s + d["contribution"])
    return told.groupBy("country").agg(F.count("*").alias("n_rows"), F.count_if(F.abs(added - F.col("log_odds")) > 1e-6).alias("off"))


@query("x05_tree_top_drivers", uses="lab", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, 3 AS named, 1 AS in_order, 1 AS signed FROM lab""")
def _(spark, path):
    """Three drivers a row, by falling size, each with the sign of its contribution."""
    rows, model = boosted(spark, path)
    told = explain.top_drivers(contributions.with_contributions(rows, model), 3)
    best = explain.ranked(F.col("drivers"), 3)
    names = F.split("top_risk_drivers", "; ")
    sizes = F.transform(best, lambda d: -F.abs(d["contribution"]))
    right = F.transform(best, lambda d: F.concat(d["feature"], F.when(d["contribution"] >= 0, "(+)").otherwise("(-)")))
    return told.select(*_IDS[:2], F.size(names).alias("named"), (sizes == F.array_sort(sizes)).cast("int").alias("in_order"),
                       (right == names).cast("int").alias("signed"))


@query("x06_tree_importance", uses="lab", sql=f"""
SELECT feature, (SELECT count(*) FROM lab) AS n_rows, 1 AS not_negative, 1 AS zero_if_never_split
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in sv.PANEL_FEATURES)}]) AS feature)""")
def _(spark, path):
    """Mean absolute contribution of each feature; zero exactly where no tree splits on it."""
    rows, model = boosted(spark, path)
    told = contributions.with_contributions(rows, model)
    means = explain.global_importance(told).join(model.importance(spark).withColumnRenamed("importance", "gain"), "feature")
    n = told.agg(F.count("*")).scalar()
    return means.select(
        "feature", n.alias("n_rows"), (F.col("importance") >= 0).cast("int").alias("not_negative"),
        ((F.col("importance") > 0) == (F.col("gain") > 0)).cast("int").alias("zero_if_never_split"))


@query("x04_surrogate_contributions_add_up", uses="lab", sql="SELECT count(*) AS n_rows, 0 AS off, 1 AS r2_in_range FROM lab")
def _(spark, path):
    """Contributions and the mean make the surrogate's score for every row."""
    rows, _dev, features = split_and_fit(spark, path)
    model = train.fit_ensemble(train.weighted(rows, PARAMS), features, PARAMS, 1)
    scored = stored(model.raw(rows))
    weights, means, r2 = explain.surrogate(scored, features)
    told = explain.linear_contributions(scored, weights, means)
    added = F.aggregate("drivers", F.lit(0.0), lambda a, d: a + d["contribution"])
    plain = sum((F.lit(w) * F.col(f).cast("double") for f, w in weights.items()), F.lit(0.0))
    centre = sum(w * means[f] for f, w in weights.items())
    return told.agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(added - (plain - centre)) > 1e-6).alias("off"),
        F.lit(int(0 <= r2 <= 1)).alias("r2_in_range"))
