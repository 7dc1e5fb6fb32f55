"""Evaluation, thresholds, splits and score bands on a formula score with many ties."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from duescope.functions import bands
from duescope.operators import evaluate as ev
from duescope.operators import score, splits
from duescope.plans import fixtures as fx
from duescope.plans import sqlviews as sv
from duescope.plans.q_features import PAID, labelled
from duescope.plans.registry import query
from duescope.storage import stored

sv.view("lab", "expo label", """
SELECT e.customer_id, e.snapshot_date, e.country, total_outstanding,
  coalesce(collected_30d, 0) / total_outstanding AS collection_ratio,
  CASE WHEN coalesce(collected_30d, 0) / total_outstanding < 0.4 THEN 1 ELSE 0 END AS target
FROM expo e LEFT JOIN label USING (customer_id, snapshot_date) WHERE total_outstanding > 0""")
sv.view("scored", "lab", """
SELECT customer_id, snapshot_date, country, substr(country, 1, 1) AS cluster, target AS label,
  round(CAST(CAST(customer_id AS BIGINT) * 37 % 101 AS DOUBLE) / CAST(101 AS DOUBLE), 4) AS score,
  collection_ratio, total_outstanding FROM lab""")
sv.view("sliced", "scored", """
SELECT *, 'POOLED' AS slice FROM scored UNION ALL SELECT *, country AS slice FROM scored""")


def points_sql(name: str, source: str, keys: str) -> None:
    by = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    sv.view(name, source, f"""
SELECT *, sum(at_pos) OVER ({part}) AS n_pos, sum(at_neg) OVER ({part}) AS n_neg,
  sum(at_pos) OVER ({part} ORDER BY score DESC) AS tp,
  sum(at_neg) OVER ({part} ORDER BY score DESC) AS fp
FROM (SELECT {by}score, count(*) FILTER (label = 1) AS at_pos,
  count(*) FILTER (label = 0) AS at_neg FROM {source} GROUP BY {by}score)""")


points_sql("pts", "scored", "")
points_sql("pts_country", "scored", "country")
points_sql("pts_slice", "sliced", "slice")
_RANKING = """sum(at_pos / n_pos * tp / (tp + fp)) AS pr_auc,
  sum(at_pos * (n_neg - fp + at_neg / 2.0)) / max(n_pos * n_neg) AS roc_auc"""


def scored_table(spark, path):
    """The scored rows as a table, for reports that read them more than once."""
    return stored(scored(spark, path))


def scored(spark, path):
    number = F.col("customer_id").cast("bigint")
    return labelled(spark, path, columns=PAID).select(
        "customer_id", "snapshot_date", "country", F.substring("country", 1, 1).alias("cluster"),
        F.col("target").alias("label"),
        F.round((number * 37 % 101).cast("double") / 101.0, 4).alias("score"),
        "collection_ratio", "total_outstanding")


@query("e01_pr_points", uses="pts", spec="threshold:4 precision:9 recall:9", sql="""
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  tp / (tp + fp) AS precision, tp / n_pos AS recall FROM pts""")
def _(spark, path):
    return ev.pr_points(ev.score_points(scored(spark, path), []), [])


@query("e01_pr_points_by_country", uses="pts_country", spec="threshold:4 precision:9 recall:9",
       sql="""SELECT country, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  tp / (tp + fp) AS precision, tp / nullif(n_pos, 0) AS recall FROM pts_country""")
def _(spark, path):
    return ev.pr_points(ev.score_points(scored(spark, path), ["country"]), ["country"])


@query("e02_average_precision", uses="pts_country", spec="pr_auc:9", sql=f"""
SELECT country, pr_auc FROM (SELECT country, {_RANKING} FROM pts_country GROUP BY country)""")
def _(spark, path):
    points = ev.score_points(scored(spark, path), ["country"])
    return ev.ranking_metrics(points, ["country"]).select("country", "pr_auc")


@query("e03_roc_auc", uses="scored", spec="roc_auc:9", sql="""
SELECT avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS roc_auc
FROM (SELECT score, label FROM scored WHERE label = 1) p
JOIN (SELECT score, label FROM scored WHERE label = 0) n ON TRUE""")
def _(spark, path):
    return ev.ranking_metrics(ev.score_points(scored(spark, path), []), []).select("roc_auc")


@query("e04_threshold_at_recall", uses="pts", spec="threshold:6", sql="""
SELECT score AS threshold FROM pts WHERE tp / n_pos >= 0.8
ORDER BY tp / (tp + fp) DESC, score LIMIT 1""")
def _(spark, path):
    return ev.threshold_at_recall(ev.score_points(scored(spark, path), []), [], 0.8)


def grid_sql(start: float, stop: float, count: int) -> str:
    return f"""
SELECT i AS step, CAST({start} AS DOUBLE) + i * CAST({(stop - start) / (count - 1)!r} AS DOUBLE) AS threshold
FROM (SELECT unnest(range({count})) AS i)"""


def curve_view(name: str, grid: ev.Grid) -> None:
    f = ", ".join(f"coalesce((1 + {b * b}) * tp / nullif((1 + {b * b}) * tp + {b * b} * fn + fp, 0), 0) AS f{b}"
                  for b in (1, 2, 3))
    sv.view(name, "scored", f"""
SELECT *, tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall, {f} FROM (
  SELECT CAST(step AS INTEGER) AS step, threshold, count(*) FILTER (score >= threshold AND label = 1) AS tp,
    count(*) FILTER (score >= threshold AND label = 0) AS fp,
    count(*) FILTER (score < threshold AND label = 1) AS fn
  FROM ({grid_sql(grid.start, grid.stop, grid.count)}) CROSS JOIN scored GROUP BY step, threshold)""")


for _name, _grid in (("curve_p", ev.PRECISION_GRID), ("curve_f", ev.F_GRID),
                     ("curve_n", ev.NEAREST_GRID), ("curve_t", ev.TABLE_GRID)):
    curve_view(_name, _grid)


@query("e05_grid_precision_at_recall", uses="curve_p", spec="threshold:9 precision:9", sql="""
SELECT threshold, precision FROM curve_p WHERE recall >= 0.75
ORDER BY precision DESC, step LIMIT 1""")
def _(spark, path):
    return ev.grid_precision_at_recall(scored(spark, path), 0.75)


@query("e06_highest_threshold_with_recall", uses="curve_p", spec="threshold:9", sql="""
SELECT max(threshold) AS threshold FROM curve_p WHERE recall >= 0.75""")
def _(spark, path):
    return ev.highest_threshold_with_recall(scored(spark, path), 0.75)


for _beta in (1, 2, 3):
    @query(f"e06_best_f{_beta}_threshold", uses="curve_f", spec="threshold:9 threshold_value:9",
           sql=f"""SELECT threshold, f{_beta} AS threshold_value FROM curve_f
ORDER BY f{_beta} DESC, step LIMIT 1""")
    def _(spark, path, beta=_beta):
        return ev.best_f_threshold(scored(spark, path), beta)


@query("e06_threshold_nearest_recall", uses="curve_n", spec="threshold:9", sql="""
SELECT threshold FROM curve_n ORDER BY abs(recall - 0.79), step LIMIT 1""")
def _(spark, path):
    return ev.threshold_nearest_recall(scored(spark, path))


@query("e06_precision_recall_table", uses="curve_t", spec="threshold:9 precision:9 recall:9",
       sql="SELECT threshold, precision, recall FROM curve_t")
def _(spark, path):
    return ev.threshold_curve(scored(spark, path), ev.TABLE_GRID).select(
        "threshold", "precision", "recall")


@query("e13_threshold_curves", uses="curve_f",
       spec="threshold:9 precision:9 recall:9 f1:9 f2:9 f3:9", sql="SELECT * FROM curve_f")
def _(spark, path):
    return ev.threshold_curve(scored(spark, path), ev.F_GRID)


_REPORT_SQL = """
SELECT {keys} max({t}) AS threshold_used, count(*) AS n, count(*) FILTER (label = 1) AS n_pos,
  count(*) FILTER (score >= {t} AND label = 1) AS tp, count(*) FILTER (score >= {t} AND label = 0) AS fp,
  count(*) FILTER (score < {t} AND label = 1) AS fn, count(*) FILTER (score < {t} AND label = 0) AS tn,
  avg(-CASE WHEN label = 1 THEN ln(greatest(least(score, 1 - 1e-7), 1e-7))
    ELSE ln(1 - greatest(least(score, 1 - 1e-7), 1e-7)) END) AS logloss,
  avg(pow(score - label, 2)) AS brier FROM {source} GROUP BY ALL"""
_RATES_SQL = """coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1,
  coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) AS f2,
  coalesce(10 * tp / nullif(10 * tp + 9 * fn + fp, 0), 0) AS f3,
  (tp + tn) / n AS accuracy, tn / greatest(tn + fp, 1) AS specificity,
  fn / (tp + fn + 1e-9) AS fn_rate, tp + fp AS n_flagged, n_pos / greatest(n, 1) AS pos_rate"""
_METRICS = ("threshold_used:6 logloss:6 brier:6 precision:9 recall:9 f1:9 f2:9 f3:9 accuracy:9 "
            "specificity:9 fn_rate:9 pos_rate:9 pr_auc:9 roc_auc:9")


@query("e08_full_metric_set", uses="scored pts", spec=_METRICS, sql=f"""
SELECT r.*, {_RATES_SQL}, (SELECT sum(at_pos / n_pos * tp / (tp + fp)) FROM pts) AS pr_auc,
  (SELECT sum(at_pos * (n_neg - fp + at_neg / 2.0)) / max(n_pos * n_neg) FROM pts) AS roc_auc
FROM ({_REPORT_SQL.format(keys='', t='0.5', source='scored')}) r""")
def _(spark, path):
    return ev.operating_report(scored_table(spark, path), [], F.lit(0.5))


sv.view("slice_t", "pts_slice", """
SELECT slice, score AS threshold FROM pts_slice WHERE tp / n_pos >= 0.8
QUALIFY row_number() OVER (PARTITION BY slice ORDER BY tp / (tp + fp) DESC, score) = 1""")


@query("e07_slice_report", uses="sliced pts_slice slice_t",
       spec="threshold:6 recall:9 precision:9 f1:9 f2:9 pr_auc:9 roc_auc:9", sql=f"""
SELECT slice, threshold_used AS threshold, n, n_pos, recall, precision, f1, f2, pr_auc, roc_auc
FROM (SELECT *, {_RATES_SQL} FROM (
  {_REPORT_SQL.format(keys='slice,', t='threshold', source='(SELECT * FROM sliced JOIN slice_t USING (slice))')}))
JOIN (SELECT slice, {_RANKING} FROM pts_slice GROUP BY slice) USING (slice)""")
def _(spark, path):
    rows = scored_table(spark, path)
    points = ev.score_points(ev.with_pooled(rows, "country"), ["slice"])
    thresholds = ev.threshold_at_recall(points, ["slice"], 0.8)
    return ev.slice_report(rows, thresholds, "country")


_TOP_SQL = """
SELECT share, n_top, sum(at_pos * greatest(least(n_top - (tp + fp - at_pos - at_neg), at_pos + at_neg), 0)
  / (at_pos + at_neg)) / (max(n_pos) + 1e-9) AS recall
FROM (SELECT pts.*, share, CAST(greatest(floor((n_pos + n_neg) * share), 1) AS BIGINT) AS n_top
  FROM pts CROSS JOIN ({shares})) GROUP BY share, n_top"""


@query("e10_recall_at_top_share", uses="pts", spec="share:4 recall:9", sql=_TOP_SQL.format(
    shares="SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE]) AS share"))
def _(spark, path):
    return ev.top_share_recall(scored(spark, path), [0.1, 0.2, 0.3])


_SHARES = [i / 100 for i in range(1, 101)]


@query("e10_recall_curve", uses="pts", spec="share:4 recall:9", sql=_TOP_SQL.format(
    shares="SELECT i / CAST(100 AS DOUBLE) AS share FROM (SELECT unnest(range(1, 101)) AS i)"))
def _(spark, path):
    return ev.top_share_recall(scored(spark, path), _SHARES)


@query("e09_recall_focused_set", uses="scored pts",
       spec="recall:9 fn_rate:9 precision:9 f3:9 recall_at_top_20:9", sql=f"""
SELECT recall, fn_rate, fn, tp, precision, f3, (SELECT recall FROM (
  {_TOP_SQL.format(shares="SELECT 0.2::DOUBLE AS share")})) AS recall_at_top_20
FROM (SELECT r.*, {_RATES_SQL} FROM ({_REPORT_SQL.format(keys='', t='0.5', source='scored')}) r)""")
def _(spark, path):
    rows = scored_table(spark, path)
    top = ev.top_share_recall(rows, [0.2]).select("recall").scalar()
    return ev.operating_report(rows, [], F.lit(0.5)).select(
        "recall", "fn_rate", "fn", "tp", "precision", "f3").withColumn("recall_at_top_20", top)


@query("e11_macro_average_precision", uses="pts_country", spec="score:9", sql=f"""
SELECT count(pr_auc) AS groups_used, avg(pr_auc) AS score FROM (
  SELECT country, {_RANKING} FROM pts_country WHERE n_pos > 0 AND n_neg > 0 GROUP BY country)""")
def _(spark, path):
    return ev.macro_average_precision(scored_table(spark, path), "country")


@query("e12_country_thresholds", uses="pts_country pts scored", spec="threshold:6 pool_threshold:6",
       sql="""
SELECT c.country, c.n_pos, CASE WHEN c.n_pos >= 210 AND c.n_pos < c.n THEN own ELSE shared END AS threshold,
  shared AS pool_threshold, CASE WHEN c.n_pos >= 210 AND c.n_pos < c.n THEN 1 ELSE 0 END AS is_own
FROM (SELECT country, count(*) AS n, count(*) FILTER (label = 1) AS n_pos FROM scored GROUP BY country) c
JOIN (SELECT country, score AS own FROM pts_country WHERE tp / n_pos >= 0.8
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY tp / (tp + fp) DESC, score) = 1) USING (country)
CROSS JOIN (SELECT score AS shared FROM pts WHERE tp / n_pos >= 0.8
  ORDER BY tp / (tp + fp) DESC, score LIMIT 1)""")
def _(spark, path):
    return ev.thresholds_with_fallback(scored_table(spark, path), "country", 0.8, min_positives=210)


@query("e14_roc_points", uses="pts", spec="threshold:4 fpr:9 tpr:9", sql="""
SELECT score AS threshold, fp / n_neg AS fpr, tp / n_pos AS tpr FROM pts""")
def _(spark, path):
    return ev.roc_points(ev.score_points(scored(spark, path), []), [])


@query("e15_calibration_bins", uses="scored", spec="mean_score:9 positive_rate:9", sql="""
SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(score) AS mean_score,
  avg(label) AS positive_rate FROM scored GROUP BY 1""")
def _(spark, path):
    return ev.calibration_bins(scored(spark, path))


@query("e16_band_capture", uses="scored", spec="capture:9 rate:9", sql="""
SELECT band, count(*) AS total, count(*) FILTER (label = 1) AS positives,
  count(*) FILTER (label = 1) / sum(count(*) FILTER (label = 1)) OVER () AS capture, avg(label) AS rate
FROM (SELECT *, CASE WHEN score <= 0.4 THEN 'Low' WHEN score <= 0.7 THEN 'Medium' ELSE 'High' END AS band
  FROM scored) GROUP BY band""")
def _(spark, path):
    return ev.band_capture(scored(spark, path).withColumn("band", bands.fixed_band(F.col("score"))))


@query("e17_score_density_by_class", uses="scored", sql="""
SELECT label, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM scored
GROUP BY 1, 2""")
def _(spark, path):
    return ev.score_density(scored(spark, path), "label")


@query("e18_confusion_per_cluster", uses="scored", sql="""
SELECT cluster, label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n
FROM scored GROUP BY ALL""")
def _(spark, path):
    return ev.confusion_matrix(scored(spark, path), F.lit(0.5), ["cluster"])


# bands and routing


_CUTS = """CASE substr(country, 1, 1) WHEN 'A' THEN 0.35 ELSE 0.4 END AS low_cut,
  CASE substr(country, 1, 1) WHEN 'A' THEN 0.65 ELSE 0.7 END AS high_cut"""


@query("p22_fixed_bands_per_country", uses="scored", spec="snapshot_date:d score:6", sql=f"""
SELECT customer_id, snapshot_date, score, CASE WHEN score <= low_cut THEN 'Low'
  WHEN score <= high_cut THEN 'Medium' ELSE 'High' END AS band FROM (SELECT *, {_CUTS} FROM scored)""")
def _(spark, path):
    rows = scored_table(spark, path)
    first = F.substring("country", 1, 1) == "A"
    registry = rows.select("country").distinct().withColumns({
        "low_cut": F.when(first, 0.35).otherwise(0.4),
        "high_cut": F.when(first, 0.65).otherwise(0.7)})
    return score.with_registry_bands(rows, registry).select(
        "customer_id", "snapshot_date", "score", "band")


@query("p23_threshold_bands", uses="scored", spec="snapshot_date:d score:6", sql="""
SELECT customer_id, snapshot_date, score, CASE WHEN score < 0.4356 THEN 'Low'
  WHEN score < 0.4356 + 0.5 * (1 - 0.4356) THEN 'Medium' ELSE 'High' END AS band FROM scored""")
def _(spark, path):
    return scored(spark, path).select(
        "customer_id", "snapshot_date", "score",
        bands.threshold_band(F.col("score"), F.lit(0.4356)).alias("band"))


@query("p24_binary_prediction", uses="scored", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, CASE WHEN score >= 0.4356 THEN 1 ELSE 0 END AS binary_pred
FROM scored""")
def _(spark, path):
    return scored(spark, path).select(
        "customer_id", "snapshot_date",
        bands.flagged(F.col("score"), F.lit(0.4356)).alias("binary_pred"))


sv.view("routing", "scored", """
SELECT country, min(cluster) AS cluster, 'model_' || min(cluster) AS model_name,
  round(0.3 + 0.1 * (ascii(min(cluster)) - 65) + 0.01 * (ascii(substr(country, 2, 1)) - 65), 2) AS threshold
FROM scored GROUP BY country""")


def routing(spark, path):
    rows = scored(spark, path).groupBy("country").agg(F.min("cluster").alias("cluster"))
    step = 0.1 * (F.ascii("cluster") - 65) + 0.01 * (F.ascii(F.substring("country", 2, 1)) - 65)
    return rows.select(
        "country", "cluster", F.concat(F.lit("model_"), "cluster").alias("model_name"),
        F.round(F.lit(0.3) + step, 2).alias("threshold"))


@query("j14_routing_lookup", uses="scored routing", spec="snapshot_date:d threshold_used:4 score:6",
       sql="""
SELECT s.customer_id, s.snapshot_date, s.score, r.cluster, r.model_name, r.threshold AS threshold_used,
  CASE WHEN s.score >= r.threshold THEN 1 ELSE 0 END AS binary_pred,
  CASE WHEN score < threshold THEN 'Low' WHEN score < threshold + 0.5 * (1 - threshold) THEN 'Medium'
    ELSE 'High' END AS predicted_class
FROM scored s JOIN routing r USING (country)""")
def _(spark, path):
    rows = scored(spark, path).drop("cluster")
    return score.routed(rows, routing(spark, path)).select(
        "customer_id", "snapshot_date", "score", "cluster", "model_name", "threshold_used",
        "binary_pred", "predicted_class")


@query("m13_routing_map", uses="scored pts_country", spec="threshold:6 cluster_threshold:6", sql="""
SELECT c.country, c.cluster, 'risk_' || c.cluster AS model_name, c.n AS trained_rows,
  own.threshold, pool.threshold AS cluster_threshold
FROM (SELECT country, cluster, count(*) AS n FROM scored GROUP BY 1, 2) c
JOIN (SELECT country, score AS threshold FROM pts_country WHERE tp / n_pos >= 0.8
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY tp / (tp + fp) DESC, score) = 1) own USING (country)
JOIN (SELECT cluster, score AS threshold FROM (
  SELECT *, sum(p) OVER (PARTITION BY cluster) AS np,
    sum(p) OVER (PARTITION BY cluster ORDER BY score DESC) AS tp,
    sum(q) OVER (PARTITION BY cluster ORDER BY score DESC) AS fp FROM (
    SELECT cluster, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q
    FROM scored GROUP BY 1, 2))
  WHERE tp / np >= 0.8
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY tp / (tp + fp) DESC, score) = 1) pool USING (cluster)""")
def _(spark, path):
    return score.routing_map(scored_table(spark, path), 0.8, model_prefix="risk_")


# the whole rule: merged edges leave two intervals (cut again at the median) or one
_TERTILES = """
SELECT customer_id, snapshot_date, CASE
  WHEN k = 3 THEN CASE WHEN s <= q1 THEN 'Low' WHEN s <= q2 THEN 'Medium' ELSE 'High' END
  WHEN k = 2 AND lo < mid AND mid < hi AND s > mid THEN 'Medium' ELSE 'Low' END AS risk_band
FROM (SELECT *, len(list_distinct([lo, q1, q2, hi])) - 1 AS k FROM (
  SELECT customer_id, snapshot_date, score AS s, min(score) OVER w AS lo, max(score) OVER w AS hi,
    quantile_cont(score, 0.5) OVER w AS mid, quantile_cont(score, CAST(1 AS DOUBLE) / 3) OVER w AS q1,
    quantile_cont(score, CAST(2 AS DOUBLE) / 3) OVER w AS q2
  FROM scored WINDOW w AS (PARTITION BY country)))"""


@query("w13_score_tertiles", uses="scored", spec="snapshot_date:d", sql=_TERTILES)
def _(spark, path):
    return score.with_tertiles(scored_table(spark, path), "country", "score").select(
        "customer_id", "snapshot_date", "risk_band")


# splits


def _cut(name: str, q: float, source: str = "lab") -> str:
    return f"""(SELECT min(snapshot_date) FROM (SELECT snapshot_date,
  sum(count(*)) OVER (ORDER BY snapshot_date) AS cum, sum(count(*)) OVER () AS n
  FROM {source} GROUP BY snapshot_date) WHERE cum > floor((n - 1) * CAST({q} AS DOUBLE)))"""


@query("w08_time_quantile_split", uses="lab", spec="snapshot_date:d", sql=f"""
SELECT customer_id, snapshot_date, CASE WHEN snapshot_date > {_cut('t', 0.8)} THEN 'test'
  WHEN snapshot_date > {_cut('v', 0.85, f"(SELECT * FROM lab WHERE snapshot_date <= {_cut('t', 0.8)})")} THEN 'val'
  ELSE 'train' END AS role FROM lab""")
def _(spark, path):
    return splits.quantile_split(stored(labelled(spark, path))).select(
        "customer_id", "snapshot_date", "role")


@query("w09_fixed_date_split", uses="lab", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, CASE WHEN snapshot_date < DATE '2000-09-01' THEN 'train'
  WHEN snapshot_date < DATE '2001-02-01' THEN 'val' ELSE 'test' END AS role FROM lab""")
def _(spark, path):
    return splits.fixed_split(
        labelled(spark, path), dt.date(2000, 9, 1), dt.date(2001, 2, 1)
    ).select("customer_id", "snapshot_date", "role")


sv.view("folds", "lab", """
SELECT f.fold, l.customer_id, l.snapshot_date, l.country, l.target,
  CASE WHEN l.snapshot_date <= train_end THEN 'train' ELSE 'val' END AS role
FROM lab l JOIN (
  SELECT fold, d[size * fold] AS train_end, d[size * fold] + 30 AS val_start,
    CASE WHEN fold = 5 THEN d[n] ELSE d[least(size * (fold + 1) + 1, n)] END AS val_end
  FROM (SELECT list(DISTINCT snapshot_date ORDER BY snapshot_date) AS d,
    count(DISTINCT snapshot_date) AS n, count(DISTINCT snapshot_date) // 6 AS size FROM lab)
  CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold)) f
ON l.snapshot_date <= train_end OR l.snapshot_date BETWEEN val_start AND val_end""")


@query("w10_walk_forward_folds", uses="folds", spec="snapshot_date:d", sql="""
SELECT fold, customer_id, snapshot_date, role FROM folds WHERE fold IN (
  SELECT fold FROM folds GROUP BY fold HAVING count(*) FILTER (role = 'val') > 0
    AND count(DISTINCT target) FILTER (role = 'train') > 1)""")
def _(spark, path):
    return splits.walk_forward(stored(labelled(spark, path))).select(
        "fold", "customer_id", "snapshot_date", "role")


@query("w10_walk_forward_equal_folds", uses="lab", spec="snapshot_date:d", sql="""
WITH b AS (
  SELECT fold, d[size * fold] AS train_end, d[size * fold] + 30 AS val_start, d[least(size * (fold + 1) + 1, n)] AS val_end
  FROM (SELECT list(DISTINCT snapshot_date ORDER BY snapshot_date) AS d,
    count(DISTINCT snapshot_date) AS n, count(DISTINCT snapshot_date) // 5 AS size FROM lab)
  CROSS JOIN (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS fold)
), f AS (
  SELECT fold, customer_id, snapshot_date, CASE WHEN snapshot_date <= train_end THEN 'train' ELSE 'val' END AS role
  FROM lab JOIN b ON snapshot_date <= train_end OR snapshot_date BETWEEN val_start AND val_end
)
SELECT * FROM f WHERE fold IN (SELECT fold FROM f WHERE role = 'val')""")
def _(spark, path):
    """The older rule: the last fold ends like the others, and one class in training is no reason to drop a fold."""
    folds = splits.walk_forward(stored(labelled(spark, path)), 4, 30, to_last=False, both_classes=False)
    return folds.select("fold", "customer_id", "snapshot_date", "role")


@query("w16_fold_diagnostics", uses="folds", sql="""
SELECT fold, role, country, count(*) AS n, count(*) FILTER (target = 1) AS positives,
  CASE WHEN count(*) < 30 OR count(*) FILTER (target = 1) < 100 THEN 1 ELSE 0 END AS sparse
FROM folds GROUP BY ALL""")
def _(spark, path):
    return splits.fold_diagnostics(splits.walk_forward(stored(labelled(spark, path))))


@query("w11_last_rows_split", uses="lab", spec="snapshot_date:d", sql="""
SELECT customer_id, snapshot_date, CASE WHEN row_number() OVER (ORDER BY snapshot_date DESC,
    customer_id DESC) <= greatest(floor((SELECT count(*) FROM lab) * 0.15), 20)
  THEN 'val' ELSE 'train' END AS role FROM lab""")
def _(spark, path):
    rows = stored(labelled(spark, path))
    return splits.last_rows_split(rows, F.col("customer_id").cast("bigint")).select(
        "customer_id", "snapshot_date", "role")


@query("w11_guarded_validation_split", uses="lab", spec="snapshot_date:d", sql=f"""
SELECT customer_id, snapshot_date, CASE WHEN snapshot_date > {_cut('v', 0.85)} THEN 'val'
  ELSE 'train' END AS role FROM lab""")
def _(spark, path):
    rows = stored(labelled(spark, path))
    return splits.guarded_val_split(rows, F.col("customer_id").cast("bigint")).select(
        "customer_id", "snapshot_date", "role")


@query("w12_leave_one_country_out", uses="scored", spec="snapshot_date:d", sql="""
SELECT s.customer_id, s.snapshot_date, m.held_out,
  CASE WHEN s.country = m.held_out THEN 'test' ELSE 'train' END AS role
FROM scored s JOIN (SELECT DISTINCT cluster, country AS held_out FROM scored) m USING (cluster)""")
def _(spark, path):
    return splits.leave_one_out(scored_table(spark, path)).select(
        "customer_id", "snapshot_date", "held_out", "role")
