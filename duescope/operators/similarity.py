"""Similarity of countries from (country, feature, value) vectors.

Everything works on the long form, so any number of features needs no generated columns.
Entities are countries: a few hundred at most, hence pairwise tables stay small.
`keys` holds further grouping columns, such as a resample number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.operators import linkage
from duescope.storage import stored


def median_imputed(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Nulls become the median of the feature over all countries."""
    on = [*(keys or []), "feature"]
    medians = long.groupBy(*on).agg(F.median("value").alias("_median"))
    return long.join(medians, on).withColumn("value", F.coalesce("value", "_median")).drop("_median")


def standardized(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """z score per feature with the population deviation; a constant feature becomes 0."""
    feature = Window.partitionBy(*(keys or []), "feature")
    spread = F.stddev_pop("value").over(feature)
    z = F.try_divide(F.col("value") - F.avg("value").over(feature), F.when(spread > 1e-12, spread))
    return long.withColumn("z", F.coalesce(z, F.lit(0.0)))


def pairwise(zs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Euclidean and cosine distance of every ordered pair of different countries."""
    on = [*(keys or []), "feature"]
    a = zs.select(*on, F.col("country"), F.col("z").alias("za"))
    b = zs.select(*on, F.col("country").alias("neighbor"), F.col("z").alias("zb"))
    za, zb = F.col("za"), F.col("zb")
    cosine = F.try_divide(F.sum(za * zb), F.sqrt(F.sum(za * za)) * F.sqrt(F.sum(zb * zb)))
    return (
        a.join(b, on).filter(F.col("country") != F.col("neighbor"))
        .groupBy(*(keys or []), "country", "neighbor").agg(
            F.sqrt(F.sum(F.pow(za - zb, 2))).alias("dist_eucl"),
            (1 - F.coalesce(cosine, F.lit(0.0))).alias("dist_cos")))


def nearest(pairs: DataFrame, k: int, metric: str = "dist_eucl", keys: list[str] | None = None
            ) -> DataFrame:
    """The k nearest countries of each country; equal distances by name."""
    order = Window.partitionBy(*(keys or []), "country").orderBy(
        F.round(metric, 12), "neighbor")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select(
        *(keys or []), "country", "neighbor", "rank", F.col(metric).alias("distance"))


def neighbor_table(pairs: DataFrame, k: int) -> DataFrame:
    """Nearest neighbours under both metrics, tagged with the metric."""
    return nearest(pairs, k, "dist_eucl").withColumn("metric", F.lit("dist_eucl")).unionByName(
        nearest(pairs, k, "dist_cos").withColumn("metric", F.lit("dist_cos")))


def donor_routing(candidates: DataFrame, sizes: DataFrame, min_customers: int) -> DataFrame:
    """Nearest and second nearest large country of each small one.

    `candidates` (country, neighbor, distance) may be all pairs or a top-k table; a small
    country without a large candidate keeps empty donors.
    """
    big = sizes.filter(F.col("n_customers") >= min_customers).select(
        F.col("country").alias("neighbor"))
    small = sizes.filter(F.col("n_customers") < min_customers).select("country", "n_customers")
    order = Window.partitionBy("country").orderBy(F.round("distance", 12), "neighbor")
    best = (
        candidates.join(big, "neighbor", "left_semi")
        .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= 2)
        .groupBy("country").agg(*[
            F.max(F.when(F.col("_r") == r, F.col(c))).alias(n)
            for r, c, n in ((1, "neighbor", "donor_country"), (1, "distance", "donor_dist"),
                            (2, "neighbor", "runner_up"), (2, "distance", "runner_up_dist"))]))
    return small.join(best, "country", "left")


def proxy_models(neighbors: DataFrame, low_data: DataFrame, trained: DataFrame) -> DataFrame:
    """Nearest trained country within the neighbour table, null if there is none."""
    with_model = neighbors.join(
        trained.select(F.col("country").alias("neighbor")), "neighbor", "left_semi")
    best = with_model.groupBy("country").agg(
        F.min(F.struct(F.round("distance", 12).alias("d"), "neighbor", "distance")).alias("b"))
    return low_data.select("country").join(best, "country", "left").select(
        "country", F.col("b.neighbor").alias("proxy_country"), F.col("b.distance").alias("distance"))


def silhouettes(pairs: DataFrame, labels: DataFrame, metric: str = "dist_eucl", keys: list[str] | None = None) -> DataFrame:
    """(keys, country, cluster, a, b, silhouette); 0 for the only member of a cluster. `keys` tell
    several clusterings in `labels` apart."""
    keys = keys or []
    own = labels.select(*keys, "country", "cluster")
    other = labels.select(*keys, F.col("country").alias("neighbor"), F.col("cluster").alias("_other"))
    to_cluster = pairs.join(own, "country").join(other, [*keys, "neighbor"]).groupBy(
        *keys, "country", "cluster", "_other").agg(F.avg(metric).alias("d"))
    same = F.col("cluster") == F.col("_other")
    ab = to_cluster.groupBy(*keys, "country", "cluster").agg(
        F.max(F.when(same, F.col("d"))).alias("a"), F.min(F.when(~same, F.col("d"))).alias("b"))
    width = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return ab.withColumn("silhouette", F.coalesce(
        F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), width), F.lit(0.0)))


def clustering_score(sil: DataFrame, cophenetic: Column | float = 0.0) -> DataFrame:
    """Mean silhouette, balance (smallest / largest cluster) and the combined score: silhouette
    + 0.3 * cophenetic - 0.15 * (1 - balance). It is -1 with fewer than two clusters or any
    single-member cluster. `cophenetic` is the correlation of the tree that the labels come from."""
    tree = cophenetic if isinstance(cophenetic, Column) else F.lit(float(cophenetic))
    sizes = sil.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("silhouette").alias("s"))
    out = sizes.agg(
        F.count("*").alias("k"), (F.sum("s") / F.sum("n")).alias("silhouette"),
        F.min("n").alias("smallest"), (F.min("n") / F.max("n")).alias("balance"))
    fair = (F.col("k") >= 2) & (F.col("smallest") >= 2)
    return out.withColumn("score", F.when(
        fair, F.col("silhouette") + 0.3 * tree - 0.15 * (1 - F.col("balance"))).otherwise(-1.0))


def _vectors(zs: DataFrame) -> DataFrame:
    """(country, features vector), components in feature-name order."""
    from pyspark.ml.functions import array_to_vector

    ordered = F.array_sort(F.collect_list(F.struct("feature", "z")))
    return zs.groupBy("country").agg(
        array_to_vector(F.transform(ordered, lambda s: s["z"])).alias("features"))


def principal_components(zs: DataFrame, variance: float = 0.9, exactly: int | None = None
                         ) -> DataFrame:
    """(country, component, value, explained): components up to a share of the variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    vectors = _vectors(zs)
    width = zs.select("feature").distinct().count()
    model = PCA(k=width, inputCol="features", outputCol="pcs").fit(vectors)
    shares = [float(v) for v in model.explainedVariance.toArray()]
    keep, total = 0, 0.0
    while keep < width and (total < variance if exactly is None else keep < exactly):
        total += shares[keep]
        keep += 1
    values = model.transform(vectors).select(
        "country", F.posexplode(F.slice(vector_to_array("pcs"), 1, keep)).alias("component", "value"))
    explained = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("component") + 1)
    return values.withColumn("explained", explained)


def behaviour_map(zs: DataFrame, sizes: DataFrame) -> DataFrame:
    """First two components side by side, with their explained shares and customer counts."""
    pcs = principal_components(zs, exactly=2)
    pick = {f"{n}{i + 1}": F.max(F.when(F.col("component") == i, F.col(c)))
            for i in (0, 1) for n, c in (("pc", "value"), ("explained", "explained"))}
    wide = pcs.groupBy("country").agg(*[c.alias(n) for n, c in pick.items()])
    return wide.join(sizes.select("country", "n_customers"), "country")


def kmeans(zs: DataFrame, k: int, seed: int = 42) -> DataFrame:
    from pyspark.ml.clustering import KMeans

    vectors = _vectors(zs)
    return KMeans(k=k, seed=seed, initMode="k-means||", maxIter=50).fit(vectors).transform(
        vectors).select("country", F.col("prediction").alias("cluster"))


def bisecting(zs: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Divisive hierarchy cut at k clusters."""
    from pyspark.ml.clustering import BisectingKMeans

    vectors = _vectors(zs)
    return BisectingKMeans(k=k, seed=seed).fit(vectors).transform(vectors).select(
        "country", F.col("prediction").alias("cluster"))


def cluster_candidates(zs: DataFrame, k_min: int = 2, k_max: int = 8) -> DataFrame:
    """Scores of k-means, the bisecting hierarchy and the agglomerative trees (ward, average,
    complete) for each k; the best silhouette has rank 1.

    `zs` is the country-sized vector table, so each fit is tiny; pairs and trees are made once. All
    labels go into one table, and one pass scores them all.
    """
    zs = stored(zs)
    pairs = stored(pairwise(zs).select("country", "neighbor", "dist_eucl"))
    ks = range(k_min, k_max + 1)
    tagged = [
        fit(zs, k).select(F.lit(name).alias("method"), F.lit(k).alias("requested_k"), "country", "cluster", F.lit(0.0).alias("cophenetic"))
        for name, fit in (("kmeans", kmeans), ("bisecting", bisecting)) for k in ks]
    for method in linkage.METHODS:
        tree = linkage.merges(pairs, method)
        faithful = stored(pairs.limit(1).select(linkage.cophenetic_correlation(tree, pairs).alias("c"))).first()["c"]
        tagged.append(linkage.labels_at(tree, zs, list(ks)).select(
            F.lit(method).alias("method"), F.col("k").alias("requested_k"), "country", "cluster", F.lit(faithful).alias("cophenetic")))
    tried = stored(reduce(DataFrame.unionByName, tagged))
    case = ["method", "requested_k"]
    sil = silhouettes(pairs, tried, keys=case)
    sizes = sil.groupBy(*case, "cluster").agg(F.count("*").alias("n"), F.sum("silhouette").alias("s"))
    scored = sizes.groupBy(*case).agg(
        F.count("*").alias("k"), (F.sum("s") / F.sum("n")).alias("silhouette"),
        F.min("n").alias("smallest"), (F.min("n") / F.max("n")).alias("balance"))
    trees = tried.groupBy(*case).agg(F.max("cophenetic").alias("cophenetic"))
    fair = (F.col("k") >= 2) & (F.col("smallest") >= 2)
    score = F.col("silhouette") + 0.3 * F.col("cophenetic") - 0.15 * (1 - F.col("balance"))
    out = scored.join(trees, case).withColumn("score", F.when(fair, score).otherwise(-1.0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("silhouette"), "requested_k", "method")
    return out.withColumn("rank", F.row_number().over(order))


def bootstrap_stability(customers: DataFrame, vector, runs: int, keep: Column) -> DataFrame:
    """Share of resamples in which a country keeps its nearest neighbour.

    `vector(rows, keys)` builds the long behaviour vector per keys; `keep` decides per row
    and resample number `r` whether the customer is in the resample. All resamples run as
    one job with r in every key.
    """
    base = nearest(pairwise(standardized(vector(customers, ["country"]))), 1).select(
        "country", F.col("neighbor").alias("baseline_top1"))
    resampled = customers.withColumn(
        "r", F.explode(F.sequence(F.lit(1), F.lit(runs)))).filter(keep)
    zs = standardized(vector(resampled, ["r", "country"]), ["r"])
    top = nearest(pairwise(zs, ["r"]), 1, keys=["r"])
    return base.join(top, "country", "left").groupBy("country", "baseline_top1").agg(
        F.avg((F.col("neighbor") == F.col("baseline_top1")).cast("double")).alias("agreement_rate"),
        F.count("r").alias("runs"))


def cluster_profile(zs: DataFrame, labels: DataFrame) -> DataFrame:
    return zs.join(labels, "country").groupBy("cluster", "feature").agg(
        F.avg("z").alias("mean_z"))


def why_similar(zs: DataFrame, one: str, two: str, n: int = 10) -> DataFrame:
    """Features where two countries are closest and farthest, by absolute z difference."""
    gap = zs.filter(F.col("country").isin(one, two)).groupBy("feature").agg(
        F.abs(F.max(F.when(F.col("country") == one, F.col("z")))
              - F.max(F.when(F.col("country") == two, F.col("z")))).alias("gap"))
    exact = F.round("gap", 12)
    return gap.orderBy(exact, "feature").limit(n).withColumn("side", F.lit("closest")).unionByName(
        gap.orderBy(exact.desc(), "feature").limit(n).withColumn("side", F.lit("farthest")))


def donor_confidence(routing: DataFrame, stability: DataFrame, low: float = 0.5) -> DataFrame:
    return routing.join(stability.select("country", "agreement_rate"), "country", "left").withColumn(
        "low_confidence", (F.coalesce("agreement_rate", F.lit(0.0)) < low).cast("int"))


def distance_matrix(pairs: DataFrame, countries: list[str], metric: str = "dist_eucl"
                    ) -> DataFrame:
    """Wide form with one column per listed country; 0 on the diagonal."""
    wide = pairs.groupBy("country").pivot("neighbor", countries).agg(F.first(metric))
    return wide.select("country", *[
        F.when(F.col("country") == c, 0.0).otherwise(F.col(c)).alias(c) for c in countries])


def cluster_overview(labels: DataFrame, sizes: DataFrame) -> DataFrame:
    return labels.join(sizes.select("country", "n_customers"), "country").select(
        "cluster", "country", "n_customers").orderBy("cluster", F.desc("n_customers"), "country")
