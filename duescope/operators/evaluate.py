"""Exact ranking metrics, thresholds and reports over (id, group, label 0/1, score).

Equal scores are collapsed first, so nothing depends on the order of ties. Everything is
grouped; pass `groups=[]` for one pooled result, or `with_pooled` for pooled plus groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.operators.ordered import running_totals
from duescope.storage import stored

POOLED = "POOLED"
TINY = 1e-9


def with_pooled(df: DataFrame, group: str, name: str = "slice") -> DataFrame:
    """Each row once under POOLED and once under its group."""
    return df.withColumn(name, F.explode(F.array(F.lit(POOLED), F.col(group))))


def score_points(df: DataFrame, groups: list[str]) -> DataFrame:
    """One row per distinct score: positives and negatives at it (`at_*`) and at or above it."""
    counts = stored(df.groupBy(*groups, "score").agg(
        F.count_if(F.col("label") == 1).alias("at_pos"),
        F.count_if(F.col("label") == 0).alias("at_neg"),
    ))
    ranked = running_totals(counts, groups, "score", ["at_pos", "at_neg"])
    totals = {"n_pos": F.sum("at_pos"), "n_neg": F.sum("at_neg")}
    if groups:
        sizes = counts.groupBy(*groups).agg(*[c.alias(n) for n, c in totals.items()])
        ranked = ranked.join(sizes, groups)
    else:
        ranked = ranked.withColumns(
            {n: counts.agg(c.alias(n)).scalar() for n, c in totals.items()}
        )
    return ranked.withColumns({
        "tp": F.col("n_pos") - F.col("cum_at_pos") + F.col("at_pos"),
        "fp": F.col("n_neg") - F.col("cum_at_neg") + F.col("at_neg"),
    }).drop("cum_at_pos", "cum_at_neg")


def pr_points(points: DataFrame, groups: list[str]) -> DataFrame:
    return points.select(
        *groups, F.col("score").alias("threshold"), "tp", "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "n_pos").alias("recall"),
    )


def roc_points(points: DataFrame, groups: list[str]) -> DataFrame:
    return points.select(
        *groups, F.col("score").alias("threshold"),
        F.try_divide("fp", "n_neg").alias("fpr"), F.try_divide("tp", "n_pos").alias("tpr"),
    )


def ranking_metrics(points: DataFrame, groups: list[str]) -> DataFrame:
    """Step-wise average precision and Mann-Whitney ROC AUC; null where one class is missing."""
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    step = F.try_divide("at_pos", "n_pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    wins = F.col("at_pos") * (F.col("n_neg") - F.col("fp") + F.col("at_neg") / 2)
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return points.groupBy(*groups).agg(
        F.sum(F.when(both, step)).alias("pr_auc"),
        F.sum(F.when(both, wins / pairs)).alias("roc_auc"),
    )


def threshold_at_recall(points: DataFrame, groups: list[str], min_recall: float,
                        name: str = "threshold") -> DataFrame:
    """Most precise threshold with recall >= min_recall, lowest one among equals.

    Where the recall is out of reach the lowest score is taken. No positives, no threshold.
    """
    curve = pr_points(points, groups)
    fits = F.col("recall") >= min_recall
    best = F.max(F.when(fits, F.struct("precision", (-F.col("threshold")).alias("neg"))))
    widest = F.max(F.when(F.col("recall").isNotNull(), F.struct("recall", "threshold")))
    return curve.groupBy(*groups).agg(best.alias("_b"), widest.alias("_w")).select(
        *groups, F.coalesce(-F.col("_b.neg"), F.col("_w.threshold")).alias(name)
    )


def thresholds_with_fallback(df: DataFrame, group: str, min_recall: float,
                             min_positives: int = 10, pool: str | None = None) -> DataFrame:
    """Own threshold for groups with enough positives and both classes, else the pool's."""
    pool_keys = [pool] if pool else []
    own = threshold_at_recall(score_points(df, [*pool_keys, group]), [*pool_keys, group],
                              min_recall, "own")
    sizes = df.groupBy(*pool_keys, group).agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("n_pos"))
    shared = threshold_at_recall(score_points(df, pool_keys), pool_keys, min_recall, "shared")
    joined = sizes.join(own, [*pool_keys, group])
    if pool:
        joined = joined.join(shared, pool_keys)
    else:
        joined = joined.withColumn("shared", shared.scalar())
    enough = (F.col("n_pos") >= min_positives) & (F.col("n_pos") < F.col("n"))
    return joined.select(
        *pool_keys, group, "n_pos",
        F.when(enough, F.col("own")).otherwise(F.col("shared")).alias("threshold"),
        F.col("shared").alias("pool_threshold"), enough.cast("int").alias("is_own"),
    )


# ---------------------------------------------------------------------------------------
# Threshold grids


@dataclass(frozen=True)
class Grid:
    """`count` evenly spaced thresholds from `start` to `stop`."""

    start: float
    stop: float
    count: int

    @property
    def step(self) -> float:
        return (self.stop - self.start) / (self.count - 1)

    def value(self, i: Column) -> Column:
        return F.lit(self.start) + i * F.lit(self.step)

    def last_at_or_below(self, v: Column) -> Column:
        """Index of the highest threshold <= v, -1 below the grid; exact at the thresholds."""
        guess = F.floor((v - F.lit(self.start)) / F.lit(self.step)).cast("int")
        exact = (
            F.when(self.value(guess + 1) <= v, guess + 1)
            .when(self.value(guess) <= v, guess).otherwise(guess - 1)
        )
        return F.greatest(F.least(exact, F.lit(self.count - 1)), F.lit(-1))


def grid_counts(df: DataFrame, grid: Grid, groups: list[str], sums: dict[str, Column],
                value: str = "score", below: bool = False) -> DataFrame:
    """Per threshold, totals of `sums` over rows with value >= threshold (or < with `below`),
    and over all rows (`all_*`).

    Rows are counted into grid cells first; running totals then see one row per cell.
    """
    known = df.filter(F.col(value).isNotNull())
    cells = known.withColumn("_cell", grid.last_at_or_below(F.col(value))).groupBy(
        *groups, "_cell"
    ).agg(*[c.alias(n) for n, c in sums.items()])
    keyed = cells if groups else cells.withColumn("_all", F.lit(0))
    keys = groups or ["_all"]
    whole = keyed.groupBy(*keys).agg(*[F.sum(n).alias(f"all_{n}") for n in sums])
    axis = whole.withColumn("_cell", F.explode(F.sequence(F.lit(-1), F.lit(grid.count - 1))))
    dense = axis.join(keyed, [*keys, "_cell"], "left").na.fill(0, subset=list(sums))
    upward = Window.partitionBy(*keys).orderBy("_cell")
    frame = (
        upward.rowsBetween(Window.unboundedPreceding, -1) if below
        else upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    out = dense.withColumns({n: F.sum(n).over(frame) for n in sums})
    return out.filter(F.col("_cell") >= 0).select(
        *groups, F.col("_cell").alias("step"), grid.value(F.col("_cell")).alias("threshold"),
        *sums, *[f"all_{n}" for n in sums],
    )


def f_beta(beta: float) -> Column:
    """F score from tp, fp, fn columns, 0 where undefined."""
    b2 = F.lit(float(beta * beta))
    top = (1 + b2) * F.col("tp")
    return F.coalesce(F.try_divide(top, top + b2 * F.col("fn") + F.col("fp")), F.lit(0.0))


def threshold_curve(df: DataFrame, grid: Grid, groups: list[str] | None = None) -> DataFrame:
    """Counts, precision, recall and F scores per threshold of the grid."""
    groups = groups or []
    sums = {"tp": F.count_if(F.col("label") == 1), "fp": F.count_if(F.col("label") == 0)}
    counts = grid_counts(df, grid, groups, sums)
    return counts.withColumn("fn", F.col("all_tp") - F.col("tp")).select(
        *groups, "step", "threshold", "tp", "fp", "fn",
        (F.col("tp") / (F.col("tp") + F.col("fp") + TINY)).alias("precision"),
        (F.col("tp") / (F.col("tp") + F.col("fn") + TINY)).alias("recall"),
        *[f_beta(b).alias(f"f{b}") for b in (1, 2, 3)],
    )


# The grids of the operating-point searches.
PRECISION_GRID = Grid(0.001, 0.9, 500)
F_GRID = Grid(0.05, 0.7, 200)
NEAREST_GRID = Grid(0.001, 0.5, 200)
TABLE_GRID = Grid(0.01, 0.5, 50)


def _first_best(curve: DataFrame, groups: list[str], measure: Column, name: str,
                where: Column | None = None) -> DataFrame:
    """Threshold with the largest measure, the lowest one among equals."""
    key = F.struct(measure.alias("m"), (-F.col("step")).alias("s"), F.col("threshold").alias("t"))
    best = F.max(key if where is None else F.when(where, key))
    return curve.groupBy(*groups).agg(best.alias("b")).select(
        *groups, F.col("b.t").alias(name), F.col("b.m").alias(f"{name}_value")
    )


def grid_precision_at_recall(df: DataFrame, min_recall: float, groups: list[str] | None = None
                             ) -> DataFrame:
    groups = groups or []
    curve = threshold_curve(df, PRECISION_GRID, groups)
    best = _first_best(curve, groups, F.col("precision"), "threshold",
                       F.col("recall") >= min_recall)
    return best.select(
        *groups, F.coalesce("threshold", F.lit(0.5)).alias("threshold"),
        F.coalesce("threshold_value", F.lit(-1.0)).alias("precision"))


def highest_threshold_with_recall(df: DataFrame, min_recall: float,
                                  groups: list[str] | None = None) -> DataFrame:
    groups = groups or []
    curve = threshold_curve(df, PRECISION_GRID, groups)
    hit = F.max(F.when(F.col("recall") >= min_recall, F.col("threshold")))
    return curve.groupBy(*groups).agg(
        F.coalesce(hit, F.min("threshold")).alias("threshold"))


def best_f_threshold(df: DataFrame, beta: int, groups: list[str] | None = None) -> DataFrame:
    groups = groups or []
    curve = threshold_curve(df, F_GRID, groups)
    return _first_best(curve, groups, F.col(f"f{beta}"), "threshold")


def threshold_nearest_recall(df: DataFrame, target: float = 0.79,
                             groups: list[str] | None = None) -> DataFrame:
    groups = groups or []
    curve = threshold_curve(df, NEAREST_GRID, groups)
    near = -F.abs(F.col("recall") - F.lit(target))
    return _first_best(curve, groups, near, "threshold").select(*groups, "threshold")


# ---------------------------------------------------------------------------------------
# Reports at an operating point


def _confusion(groups: list[str], threshold: Column) -> dict[str, Column]:
    hit, pos = F.col("score") >= threshold, F.col("label") == 1
    return {
        "tp": F.count_if(hit & pos), "fp": F.count_if(hit & ~pos),
        "fn": F.count_if(~hit & pos), "tn": F.count_if(~hit & ~pos),
    }


def _rates() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": f_beta(1), "f2": f_beta(2), "f3": f_beta(3),
        "accuracy": (tp + tn) / (tp + fp + fn + tn),
        "specificity": tn / F.greatest(tn + fp, F.lit(1)),
        "fn_rate": fn / (tp + fn + TINY),
    }


def operating_report(df: DataFrame, groups: list[str], threshold: Column | None = None
                     ) -> DataFrame:
    """Full metric set per group. The threshold is a column of `df`, or the one given."""
    at = F.col("threshold") if threshold is None else threshold
    p = F.greatest(F.least("score", F.lit(1 - 1e-7)), F.lit(1e-7))
    loss = -F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))
    base = df.groupBy(*groups).agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("n_pos"),
        F.max(at).alias("threshold_used"),
        *[c.alias(n) for n, c in _confusion(groups, at).items()],
        F.avg(loss).alias("logloss"),
        F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier"),
    ).withColumns(_rates()).withColumns({
        "n_flagged": F.col("tp") + F.col("fp"),
        "pos_rate": F.col("n_pos") / F.greatest("n", F.lit(1)),
    })
    ranking = ranking_metrics(score_points(df, groups), groups)
    return base.join(ranking, groups) if groups else base.withColumns(
        {c: ranking.select(c).scalar() for c in ("pr_auc", "roc_auc")})


def slice_report(df: DataFrame, thresholds: DataFrame, group: str) -> DataFrame:
    """Pooled and per-group metrics, each slice at its own threshold (slice, threshold).

    A group without a threshold of its own is reported at the pooled one."""
    pooled = thresholds.filter(F.col("slice") == POOLED).agg(F.max("threshold")).scalar()
    both = with_pooled(df, group).join(thresholds, "slice", "left").withColumn(
        "threshold", F.coalesce("threshold", pooled))
    report = operating_report(both, ["slice"])
    return report.select(
        "slice", F.col("threshold_used").alias("threshold"), "n", "n_pos", "recall", "precision",
        "f1", "f2", "pr_auc", "roc_auc")


def top_share_recall(df: DataFrame, shares: list[float], groups: list[str] | None = None
                     ) -> DataFrame:
    """Share of positives among the best-scored max(1, floor(n * share)) rows.

    When the cut falls inside a group of equal scores, the positives of that group count in
    proportion to the rows taken: the expectation over any order of the ties.
    """
    groups = groups or []
    points = score_points(df, groups).withColumns({
        "above": F.col("tp") + F.col("fp") - F.col("at_pos") - F.col("at_neg"),
        "here": F.col("at_pos") + F.col("at_neg"),
        "size": F.col("n_pos") + F.col("n_neg"),
    })
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    cut = points.withColumn("share", wanted).withColumn(
        "n_top", F.greatest(F.floor(F.col("size") * F.col("share")), F.lit(1)))
    taken = F.greatest(F.least(F.col("n_top") - F.col("above"), F.col("here")), F.lit(0))
    return cut.groupBy(*groups, "share").agg(
        F.max("n_top").alias("n_top"),
        (F.sum(F.col("at_pos") * taken / F.col("here")) / (F.max("n_pos") + TINY)).alias("recall"),
    )


def macro_average_precision(df: DataFrame, group: str, per: str | None = None) -> DataFrame:
    """Mean PR-AUC over groups with both classes; pooled value when there is none. One row, or with
    `per` one for each of its values."""
    keys = [per] if per else []
    per_group = ranking_metrics(score_points(df, [*keys, group]), [*keys, group])
    pooled = ranking_metrics(score_points(df, keys), keys).select(*keys, F.col("pr_auc").alias("p"))
    means = per_group.groupBy(*keys).agg(F.count("pr_auc").alias("groups_used"), F.avg("pr_auc").alias("m"))
    if per is None:
        return means.select("groups_used", F.coalesce("m", pooled.scalar()).alias("score"))
    return pooled.join(means, per, "left").select(
        per, F.coalesce("groups_used", F.lit(0)).alias("groups_used"), F.coalesce("m", "p").alias("score"))


def calibration_bins(df: DataFrame, bins: int = 10) -> DataFrame:
    cell = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(cell.alias("bin")).agg(
        F.count("*").alias("n"), F.avg("score").alias("mean_score"),
        F.avg(F.col("label").cast("double")).alias("positive_rate"))


def band_capture(df: DataFrame, band: str = "band") -> DataFrame:
    """Per band: rows, positives, their share of all positives, positive rate."""
    per = df.groupBy(band).agg(
        F.count("*").alias("total"), F.count_if(F.col("label") == 1).alias("positives"))
    everywhere = per.agg(F.sum("positives").cast("double")).scalar()
    return per.select(
        band, "total", "positives",
        F.coalesce(F.try_divide(F.col("positives"), everywhere), F.lit(0.0)).alias("capture"),
        (F.col("positives") / F.col("total")).alias("rate"))


def score_density(df: DataFrame, by: str, bins: int = 20) -> DataFrame:
    cell = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(by, cell.alias("bin")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, threshold: Column, groups: list[str] | None = None
                     ) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return df.groupBy(*(groups or []), "label", predicted.alias("predicted")).agg(
        F.count("*").alias("n"))
