"""Risk models with Spark ML: gated search, feature selection, seed ensembles, calibration.

Rows carry `target`, `snapshot_date`, `country` and numeric features. Training data never
leaves the executors; the driver sees metrics, importances and fitted models.
"""

from __future__ import annotations

import datetime as dt
import json
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duescope.functions import bands, encoding, weights
from duescope.operators import evaluate as ev
from duescope.operators import boosting, isotonic, splits
from duescope.operators.assemble import NOT_FEATURES
from duescope.storage import new_path, stored


@dataclass(frozen=True)
class TreeParams:
    max_iter: int = 500                  # a ceiling; validation decides when to stop
    max_depth: int = 3
    step_size: float = 0.1
    subsample: float = 0.8
    min_rows_per_node: int = 10
    column_share: str = "auto"
    class_weight: float = 1.0            # multiplier on negatives / positives


CONSERVATIVE = TreeParams(max_depth=3, step_size=0.05, min_rows_per_node=10)
RESCUE = TreeParams(max_depth=3, step_size=0.1, subsample=1.0, min_rows_per_node=1)


@dataclass(frozen=True)
class TrainSettings:
    trials_full: int = 120
    trials_small: int = 30
    n_splits: int = 4
    gap_days: int = 30
    full_rows: int = 500
    full_positives: int = 100
    min_rows: int = 100
    min_positives: int = 10
    penalty_full: float = 0.5            # on the spread of fold scores
    penalty_small: float = 1.0
    importance_cutoff: float = 0.001
    min_features: int = 10
    n_seeds: int = 3
    max_iter: int = 500
    min_recall: float = 0.8
    own_threshold_positives: int = 10
    half_life_days: float = 180.0
    platt_below: int = 25


def feature_list(df: DataFrame) -> list[str]:
    """All numeric columns but identifiers, label and what leaks it."""
    skip = {*NOT_FEATURES, "role", "fold", "weight", "score", "label"}
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if c not in skip and (t in numeric or t.startswith("decimal"))]


def weighted(df: DataFrame, params: TreeParams, half_life_days: float = 180.0) -> DataFrame:
    """Recency times class weight; the class ratio is that of `df`."""
    last = df.agg(F.max("snapshot_date")).scalar()
    age = weights.recency_weight(F.col("snapshot_date"), last, half_life_days)
    with_class = weights.with_class_weight(df, multiplier=params.class_weight, name="_cw")
    return with_class.withColumn("weight", age * F.col("_cw")).drop("_cw")


def _assembled(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    ready = df.select(
        *keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_f{i}")
                 for i, c in enumerate(features)])
    names = [f"_f{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=names, outputCol="features").transform(ready).drop(*names)


def fit_trees(df: DataFrame, features: list[str], params: TreeParams, seed: int = 42,
              role: str | None = None):
    """Boosted trees on `df`; with `role`, rows marked val only decide when to stop: at the first round
    that doesn't lower their error. Spark's own tolerance, 1 % of the error, ends most fits after a tree."""
    keep = ["target", "weight"] + ([role] if role else [])
    ready = _assembled(df, features, keep)
    trees = GBTClassifier(
        labelCol="target", weightCol="weight", featuresCol="features", seed=seed,
        maxIter=params.max_iter, maxDepth=params.max_depth, stepSize=params.step_size,
        subsamplingRate=params.subsample, minInstancesPerNode=params.min_rows_per_node,
        featureSubsetStrategy=params.column_share)
    if role:
        ready = ready.withColumn("_val", F.col(role) == "val")
        trees = trees.setValidationIndicatorCol("_val").setParams(validationTol=0.0)
    return trees.fit(ready)


@dataclass
class Ensemble:
    """Mean probability of models that differ by seed, then an optional calibrator."""

    features: list[str]
    models: list
    calibrator: object | None = None
    kind: str | None = None

    def raw(self, df: DataFrame, name: str = "score") -> DataFrame:
        kept = list(df.columns)
        out = _assembled(df, self.features, kept)
        for i, model in enumerate(self.models):
            scorer = model.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}")
            out = scorer.setPredictionCol("").transform(out).withColumn(
                f"_s{i}", vector_to_array(f"_p{i}")[1])
        mean = sum((F.col(f"_s{i}") for i in range(len(self.models))), F.lit(0.0))
        return out.select(
            *[c for c in kept if c != name], (mean / len(self.models)).alias(name))

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return self.calibrated(self.raw(df, name), name)

    def calibrated(self, df: DataFrame, name: str = "score") -> DataFrame:
        if self.kind is None:
            return df
        if self.kind == "platt":
            slope, shift = float(self.calibrator.coefficients[0]), float(self.calibrator.intercept)
            value = 1 / (1 + F.exp(-(F.col(name) * slope + shift)))
            return df.withColumn(name, value)
        fitted = self.calibrator.column(df, name, "_cal")
        bounded = F.greatest(F.least("_cal", F.lit(1.0)), F.lit(0.0))
        return fitted.withColumn(name, bounded).drop("_cal")

    @property
    def trees(self) -> int:
        counts = sorted(m.getNumTrees for m in self.models)
        return counts[len(counts) // 2]

    def importance(self, spark) -> DataFrame:
        rows = [(f, float(sum(m.featureImportances[i] for m in self.models) / len(self.models)))
                for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "feature string, importance double")


PARALLEL = 4  # fits whose Spark jobs are submitted at the same time


def _side_by_side(fn: Callable, tasks: list) -> list:
    """Results in order; each task only submits Spark jobs, so driver threads are enough."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(fn, tasks))


def at_once(*made: Callable) -> list:
    """Results of independent steps, such as the fits of several pools, whose Spark jobs share the executors."""
    return _side_by_side(lambda make: make(), list(made))


def fit_ensemble(df: DataFrame, features: list[str], params: TreeParams, n_seeds: int,
                 role: str | None = None) -> Ensemble:
    models = _side_by_side(lambda i: fit_trees(df, features, params, 42 + 101 * i, role), list(range(n_seeds)))
    return Ensemble(features, models)


def calibrated(ensemble: Ensemble, val: DataFrame, platt_below: int = 25) -> Ensemble:
    """Platt with few validation positives, isotonic otherwise.

    Equal raw scores are merged into one weighted point; the scores themselves stay exact. Of an
    isotonic fit only its steps reach the driver.
    """
    raw = ensemble.raw(val.select("target", *ensemble.features))
    points = stored(raw.groupBy("score", "target").agg(
        F.count("*").cast("double").alias("w")))
    positives = points.agg(F.sum(F.when(F.col("target") == 1, F.col("w")))).first()[0] or 0.0
    if positives < platt_below:
        ready = VectorAssembler(inputCols=["score"], outputCol="x").transform(points)
        model = LogisticRegression(featuresCol="x", labelCol="target", weightCol="w").fit(ready)
        return replace(ensemble, calibrator=model, kind="platt")
    return replace(ensemble, calibrator=isotonic.fitted(points), kind="isotonic")


def size_gate(df: DataFrame, settings: TrainSettings, pool: str = "cluster") -> DataFrame:
    """Per pool: rows, positives, usable dates and the mode of training they allow."""
    sizes = df.groupBy(pool).agg(
        F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("positives"),
        F.count_distinct("snapshot_date").alias("dates"))
    n, pos = F.col("n"), F.col("positives")
    mode = (
        F.when((n < settings.min_rows) | (pos < settings.min_positives), "skip")
        .when(F.col("dates") < settings.n_splits + 1, "fixed")
        .when((n >= settings.full_rows) & (pos >= settings.full_positives), "full")
        .otherwise("small"))
    return sizes.withColumn("mode", mode)


def candidates(mode: str, trials: int, max_iter: int, depth_cap: int = 5, seed: int = 42
               ) -> list[TreeParams]:
    """Seeded random draws; the small mode is shallow and slow."""
    rng = random.Random(seed)
    small = mode == "small"
    return [
        TreeParams(
            max_iter=max_iter, max_depth=rng.randint(2, 3 if small else depth_cap),
            step_size=round(rng.uniform(0.02, 0.08 if small else 0.15), 3),
            subsample=round(rng.uniform(0.7 if small else 0.6, 0.9 if small else 0.95), 2),
            min_rows_per_node=rng.randint(1 if small else 3, 20 if small else 30),
            class_weight=round(rng.uniform(0.7 if small else 0.5, 1.2 if small else 1.3), 2))
        for _ in range(trials)]


def macro_precision(scored: DataFrame) -> float | None:
    """Mean over countries of the average precision."""
    return ev.macro_average_precision(scored, "country").first()["score"]


def composite(scored: DataFrame, at: float | None = 0.5) -> float | None:
    """Half average precision, 0.3 F2 at the threshold `at` (None: that of recall 0.8), 0.2 recall in
    the top 20 %."""
    cut = F.lit(at) if at is not None else ev.threshold_at_recall(ev.score_points(scored, []), [], 0.8).select("threshold").scalar()
    report = ev.operating_report(scored, [], cut).select("pr_auc", "f2").first()
    top = ev.top_share_recall(scored, [0.2]).first()["recall"]
    if report is None or report["pr_auc"] is None:
        return None
    return 0.5 * report["pr_auc"] + 0.3 * (report["f2"] or 0.0) + 0.2 * (top or 0.0)


def search(folds: DataFrame, features: list[str], tried: list[TreeParams], penalty: float,
           half_life_days: float = 180.0, objective: Callable[[DataFrame], float | None] = macro_precision
           ) -> DataFrame:
    """Mean minus penalty times spread of the fold scores (`objective` of label, score and
    country) for each candidate, best first. `folds` comes from `splits.walk_forward`."""
    folds = stored(folds)
    numbers = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]

    def tried_on(task: tuple[int, int]) -> tuple[int, int, float]:
        i, f = task
        part = folds.filter(F.col("fold") == f)
        train = weighted(part.filter(F.col("role") == "train"), tried[i], half_life_days)
        model = Ensemble(features, [fit_trees(train, features, tried[i])])
        val = model.raw(part.filter(F.col("role") == "val")).withColumnRenamed("target", "label")
        value = objective(stored(val.select("country", "label", "score")))
        return i, f, float(value if value is not None else 0.0)

    rows = _side_by_side(tried_on, [(i, f) for i in range(len(tried)) for f in numbers])
    spark = folds.sparkSession
    scores = spark.createDataFrame(rows, "candidate int, fold int, score double")
    summary = scores.groupBy("candidate").agg(
        F.count("*").alias("folds"), F.avg("score").alias("mean"),
        F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("spread"))
    return summary.withColumn(
        "objective", F.col("mean") - penalty * F.col("spread")).orderBy(
        F.desc("objective"), "candidate")


def rungs(n: int, max_iter: int, first: int = 2) -> list[tuple[int, int]]:
    """(candidates, rounds) of each rung: the better half goes on with twice the rounds, at least
    `first` and at most `max_iter`; the last one alone has them all."""
    out, left = [], n
    while True:
        rounds = max_iter if left == 1 else max(min(first, max_iter), max_iter >> (left - 1).bit_length())
        out.append((left, rounds))
        if left == 1:
            return out
        left = -(-left // 2)


def halving(panel: DataFrame, bounds: list[tuple[dt.date, dt.date, dt.date]], features: list[str], tried: list[TreeParams], penalty: float,
            half_life_days: float = 180.0, objective: Callable[[DataFrame], float | None] = macro_precision, date: str = "snapshot_date") -> DataFrame:
    """(rung, candidate, rounds, folds, mean, spread, objective, survives): successive halving.

    All candidates start with few rounds, and each rung doubles the rounds of the better half, so
    120 candidates of up to 500 rounds cost some eleven times 500 rounds a fold, not 120 times. The
    rounds are those of the candidates' `max_iter`. `bounds` come from `splits.usable_bounds`; each
    fold filters `panel`, a stored table or a filter on one. Equal objectives go to the earlier candidate. The scores of a
    rung are one table, whose average precisions are worked out together. A pool that fits a task is
    fitted there (`boosting`), and a survivor goes on from the trees it has.
    """
    spark = panel.sparkSession
    day, left, rows = F.col(date), list(range(len(tried))), []

    def scored(task: tuple[str, int, int, int, int]) -> None:
        path, number, i, f, rounds = task
        end, start, stop = bounds[f]
        params = replace(tried[i], max_iter=rounds)
        train = weighted(panel.where(day <= F.lit(end)), params, half_life_days)
        model = Ensemble(features, [fit_trees(train, features, params)])
        val = model.raw(panel.where(day.between(F.lit(start), F.lit(stop)))).withColumnRenamed("target", "label")
        val.select("country", "label", "score").write.parquet(f"{path}/task={number}")

    def by_spark(tasks: list[tuple[int, int]], rounds: dict[int, int]) -> DataFrame:
        path = new_path(spark, "rung")
        _side_by_side(scored, [(path, number, i, f, rounds[i]) for number, (i, f) in enumerate(tasks)])
        types = panel.select("country", F.col("target").alias("label"), F.lit(0.0).alias("score"), F.lit(0).alias("task")).schema
        return spark.read.schema(types).parquet(path)

    def in_tasks(tasks: list[tuple[int, int]], rounds: dict[int, int]) -> DataFrame:
        found = boosting.scored(blocks, [
            boosting.Job(p.max_depth, p.step_size, p.subsample, p.min_rows_per_node, p.class_weight, rounds[i], *bounds[f], half_life_days, trees.get((i, f)))
            for (i, f), p in zip(tasks, [tried[i] for i, _ in tasks])])
        for r in found.where(F.col("trees").isNotNull()).select("task", "trees").collect():
            trees[tasks[r["task"]]] = bytes(r["trees"])
        return found.where(F.col("trees").isNull()).drop("trees")

    trees: dict[tuple[int, int], bytes] = {}  # of each candidate and fold, which the next rung goes on from
    small = all(p.column_share in ("auto", "all") for p in tried) and boosting.fits_a_task(panel, features)
    blocks = boosting.packed(panel, features, date) if small else None

    def values(rounds: dict[int, int]) -> list[tuple[int, float]]:
        tasks = [(i, f) for i in left for f in range(len(bounds))]
        out = (in_tasks if small else by_spark)(tasks, rounds)
        if objective is macro_precision:
            told = {r["task"]: r["score"] for r in ev.macro_average_precision(out, "country", "task").collect()}
        else:
            told = dict(enumerate(_side_by_side(lambda n: objective(out.where(F.col("task") == n).drop("task")), list(range(len(tasks))))))
        return [(i, float(told.get(number) or 0.0)) for number, (i, _) in enumerate(tasks)]

    for number, (n, _) in enumerate(rungs(len(tried), 1)):
        left = left[:n]
        rounds = {i: rungs(len(tried), tried[i].max_iter)[number][1] for i in left}
        scores: dict[int, list[float]] = {i: [] for i in left}
        for i, value in values(rounds):
            scores[i].append(value)
        told = {}
        for i, found in scores.items():
            mean = sum(found) / len(found)
            spread = (sum((v - mean) ** 2 for v in found) / len(found)) ** 0.5
            told[i] = (mean, spread, mean - penalty * spread)
        left = sorted(left, key=lambda i: (-told[i][2], i))
        kept = set(left[:-(-n // 2)])
        rows += [(number, i, rounds[i], len(bounds), *told[i], i in kept) for i in left]
    return spark.createDataFrame(rows, "rung int, candidate int, rounds int, folds int, mean double, spread double, objective double, survives boolean")


def selected_features(model, features: list[str], cutoff: float, at_least: int) -> list[str]:
    """Features with enough importance, if enough of them remain; else all."""
    kept = [f for i, f in enumerate(features) if model.featureImportances[i] >= cutoff]
    return kept if at_least <= len(kept) < len(features) else features


def never_split(model) -> bool:
    return float(sum(model.featureImportances.values)) == 0.0


def fit_selector(df: DataFrame, features: list[str], params: TreeParams,
                 settings: TrainSettings) -> tuple[object, TreeParams]:
    """One model for feature selection; a model that never split is refitted with minimal
    regularisation, and those parameters are used from then on."""
    model = fit_trees(weighted(df, params, settings.half_life_days), features, params, role="role")
    if not never_split(model):
        return model, params
    rescue = replace(RESCUE, max_iter=params.max_iter)
    again = weighted(df, rescue, settings.half_life_days)
    return fit_trees(again, features, rescue, role="role"), rescue


@dataclass
class TrainedModel:
    name: str
    production: Ensemble
    evaluation: Ensemble
    params: TreeParams
    thresholds: DataFrame               # slice, threshold
    report: DataFrame                   # one row per slice
    tuned: bool
    rows: int
    extra: dict = field(default_factory=dict)


def train_model(rows: DataFrame, name: str, settings: TrainSettings,
                features: list[str] | None = None) -> TrainedModel | None:
    """Search, selection, ensemble, calibration, thresholds, test report and refit for one
    pool of countries. None when the pool is too small to train anything honest."""
    rows = stored(rows.withColumn("target", F.col("target").cast("int")))
    features = features or feature_list(rows)
    size = rows.agg(F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("p")).first()
    if size["n"] < settings.min_rows or size["p"] < settings.min_positives:
        return None
    roles = splits.quantile_split(rows, told=True)
    dev = roles.filter(F.col("role") != "test")

    params, tuned = replace(CONSERVATIVE, max_iter=settings.max_iter), False
    full = size["n"] >= settings.full_rows and size["p"] >= settings.full_positives
    trials = settings.trials_full if full else settings.trials_small
    if trials:
        panel = dev.drop("role")
        bounds = splits.usable_bounds(panel, settings.n_splits, settings.gap_days)
        if len(bounds) >= 2:
            tried = candidates("full" if full else "small", trials, settings.max_iter)
            penalty = settings.penalty_full if full else settings.penalty_small
            found = halving(panel, bounds, features, tried, penalty, settings.half_life_days)
            best = found.orderBy(F.desc("rung"), F.desc("objective"), "candidate").first()
            params, tuned = tried[best["candidate"]], True

    selector, params = fit_selector(dev, features, params, settings)
    features = selected_features(
        selector, features, settings.importance_cutoff, settings.min_features)
    base = fit_ensemble(weighted(dev, params, settings.half_life_days), features, params,
                        settings.n_seeds, role="role")
    val = roles.filter(F.col("role") == "val")
    honest = calibrated(base, val, settings.platt_below)

    scored_val = stored(honest.score(val).select(
        "country", F.col("target").alias("label"), "score"))
    pooled = ev.threshold_at_recall(ev.score_points(scored_val, []), [], settings.min_recall)
    own = ev.thresholds_with_fallback(
        scored_val, "country", settings.min_recall, settings.own_threshold_positives)
    thresholds = stored(
        pooled.select(F.lit(ev.POOLED).alias("slice"), "threshold").unionByName(
            own.select(F.col("country").alias("slice"), "threshold")))
    test = stored(honest.score(roles.filter(F.col("role") == "test")).select(
        "country", F.col("target").alias("label"), "score"))
    report = ev.slice_report(test, thresholds, "country").withColumn("model", F.lit(name))

    locked = replace(params, max_iter=max(1, honest.trees))
    refit = fit_ensemble(weighted(rows, locked, settings.half_life_days), features, locked,
                         settings.n_seeds)
    production = replace(refit, calibrator=honest.calibrator, kind=honest.kind)
    return TrainedModel(name, production, honest, params, thresholds, report, tuned, size["n"])


def train_per_cluster(panel: DataFrame, clusters: dict[str, list[str]], settings: TrainSettings
                      ) -> dict[str, TrainedModel]:
    """One model per cluster of countries, with country one-hots."""
    def one(name: str) -> TrainedModel | None:
        pool = encoding.one_hot(
            panel.filter(F.col("country").isin(clusters[name])), "country", sorted(clusters[name]), "country")
        return train_model(pool, name, settings)

    trained = zip(clusters, _side_by_side(one, list(clusters)))
    return {name: model for name, model in trained if model is not None}


def train_global(panel: DataFrame, clusters: dict[str, list[str]], settings: TrainSettings
                 ) -> TrainedModel | None:
    """One model for all countries, with country and cluster one-hots."""
    return train_model(encoded_for_global(panel, clusters), "global", settings)


def with_cluster(df: DataFrame, clusters: dict[str, list[str]]) -> DataFrame:
    table: Column = F.lit(None).cast("string")
    for name, countries in clusters.items():
        table = F.when(F.col("country").isin(countries), name).otherwise(table)
    return df.withColumn("cluster", table)


def routing_rows(models: dict[str, TrainedModel], clusters: dict[str, list[str]],
                 refresh_date: dt.date | None = None) -> DataFrame:
    """What serving has to know per country of a trained cluster: model, own and cluster
    threshold, training rows, seeds, calibration, whether tuned, and the day of training."""
    out = None
    for name, model in models.items():
        own = model.thresholds.filter(F.col("slice") != ev.POOLED).select(F.col("slice").alias("country"), F.col("threshold").alias("own"))
        shared = model.thresholds.filter(F.col("slice") == ev.POOLED).select("threshold").scalar()
        served = model.thresholds.sparkSession.createDataFrame([(c,) for c in sorted(clusters[name])], "country string")
        part = served.join(own, "country", "left").select(
            "country", F.lit(name).alias("cluster"), F.lit(f"risk_{name}").alias("model_name"),
            F.coalesce("own", shared).alias("threshold"), shared.alias("cluster_threshold"),
            F.lit(model.rows).cast("long").alias("trained_rows"), F.lit(len(model.production.models)).cast("long").alias("n_seeds"),
            F.lit(model.production.kind or "none").alias("calibration"), F.lit(model.tuned).alias("tuned"),
            F.lit((refresh_date or dt.date.today()).isoformat()).alias("refresh_date"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no cluster was trained")
    return out


def encoded_for_global(df: DataFrame, clusters: dict[str, list[str]]) -> DataFrame:
    """Country and cluster one-hots as `train_global` sees them."""
    countries = sorted(c for cs in clusters.values() for c in cs)
    by_cluster = with_cluster(encoding.one_hot(df, "country", countries, "country"), clusters)
    return encoding.one_hot(by_cluster, "cluster", sorted(clusters), "cluster", other="other").drop("cluster")


def score_clusters(rows: DataFrame, models: dict[str, TrainedModel], clusters: dict[str, list[str]],
                   fallback: TrainedModel | None = None, explained: bool = False) -> DataFrame:
    """Every row of `rows`, scored by its cluster's model at its country's threshold.

    `status` says how: "cluster"; "global" where the cluster has no model, or the country no
    cluster, and `fallback` (from `train_global`) scored the row at its pooled threshold; else
    "unscored", with null score and class. `explained` adds `drivers` and `base_value`, the exact
    contributions of the features to the log-odds of the model that scored the row.
    """
    from duescope.operators.contributions import with_contributions
    from duescope.operators.score import routed

    served = {name: sorted(clusters[name]) for name in models}
    kept = list(rows.columns)
    told = ["drivers", "base_value"] if explained else []

    def scored_by(model: TrainedModel, pool: DataFrame) -> DataFrame:
        out = model.production.score(pool)
        return (with_contributions(out, model.production) if explained else out).select(*kept, "score", *told)

    parts: list[DataFrame] = []
    if models:
        routing = stored(routing_rows(models, clusters).select("country", "cluster", "model_name", "threshold"))
    for name, model in models.items():
        pool = encoding.one_hot(rows.filter(F.col("country").isin(served[name])), "country", served[name], "country")
        scored = scored_by(model, pool)
        parts.append(routed(scored, routing).withColumn("status", F.lit("cluster")))
    known = [c for cs in served.values() for c in cs]
    rest = rows.filter(~F.coalesce(F.col("country").isin(known), F.lit(False)))
    if fallback is not None:
        at = fallback.thresholds.filter(F.col("slice") == ev.POOLED).select("threshold").scalar()
        scored = scored_by(fallback, encoded_for_global(rest, clusters))
        named = with_cluster(scored, clusters).withColumns({
            "model_name": F.lit("risk_global"), "threshold_used": at, "binary_pred": bands.flagged(F.col("score"), at),
            "predicted_class": bands.threshold_band(F.col("score"), at), "status": F.lit("global")})
    else:
        named = with_cluster(rest, clusters).withColumns({
            "score": F.lit(None).cast("double"), "model_name": F.lit(None).cast("string"),
            "threshold_used": F.lit(None).cast("double"), "binary_pred": F.lit(None).cast("int"),
            "predicted_class": F.lit(None).cast("string"), "status": F.lit("unscored")})
        if explained:
            nothing = "array<struct<feature:string,value:double,contribution:double>>"
            named = named.withColumns({"drivers": F.lit(None).cast(nothing), "base_value": F.lit(None).cast("double")})
    out = named
    for part in parts:
        out = out.unionByName(part)
    return out


def leave_one_out_scores(panel: DataFrame, features: list[str], params: TreeParams,
                         pool: str = "cluster") -> DataFrame:
    """For each country: a model trained on the rest of its pool, scored on the country.

    The panel is stored once and filtered per fit; nothing is multiplied by the countries.
    """
    panel = stored(panel)
    held = panel.select(pool, "country").distinct().orderBy("country").collect()

    def one(r) -> DataFrame | None:
        train = panel.filter((F.col(pool) == r[pool]) & (F.col("country") != r["country"]))
        if train.select("target").distinct().limit(2).count() < 2:
            return None
        model = Ensemble(features, [fit_trees(weighted(train, params), features, params)])
        return model.raw(panel.filter(F.col("country") == r["country"])).select(
            "country", F.col("target").alias("label"), "score")

    out = None
    for scored in _side_by_side(one, held):
        if scored is not None:
            out = scored if out is None else out.unionByName(scored)
    if out is None:
        raise ValueError("no country can be held out")
    return out


def save_model(model: TrainedModel, path: str) -> None:
    """The whole of a trained model: seeds, calibrator, features, thresholds, report, parameters."""
    spark = model.thresholds.sparkSession
    e = model.production
    for i, m in enumerate(e.models):
        m.write().overwrite().save(f"{path}/seed_{i}")
    if e.kind == "isotonic":
        e.calibrator.save(spark, f"{path}/calibrator")
    elif e.calibrator is not None:
        e.calibrator.write().overwrite().save(f"{path}/calibrator")
    about = {"name": model.name, "features": e.features, "kind": e.kind, "n_seeds": len(e.models),
             "params": asdict(model.params), "tuned": model.tuned, "rows": model.rows}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    model.thresholds.coalesce(1).write.mode("overwrite").parquet(f"{path}/thresholds")
    model.report.coalesce(1).write.mode("overwrite").parquet(f"{path}/report")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """What `save_model` wrote; its scores are those of the saved model. It evaluates as it serves."""
    from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel

    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    models = [GBTClassificationModel.load(f"{path}/seed_{i}") for i in range(about["n_seeds"])]
    calibrator = None
    if about["kind"] == "isotonic":
        calibrator = isotonic.load(spark, f"{path}/calibrator")
    elif about["kind"] == "platt":
        calibrator = LogisticRegressionModel.load(f"{path}/calibrator")
    serving = Ensemble(about["features"], models, calibrator, about["kind"])
    return TrainedModel(
        about["name"], serving, serving, TreeParams(**about["params"]), spark.read.parquet(f"{path}/thresholds"),
        spark.read.parquet(f"{path}/report"), about["tuned"], about["rows"])
