"""Country similarity on the behaviour vectors of the customer features."""

from __future__ import annotations

from pyspark.sql import functions as F

from duescope.operators import linkage, profile
from duescope.operators import similarity as sim
from duescope.plans import sqlviews as sv
from duescope.plans.q_profile import VECTOR_STATS, customers, segmented, typed, vector_sql
from duescope.plans.registry import query
from duescope.storage import stored

_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in VECTOR_STATS)


def long_sql(source: str, customers: str, apart: str = "") -> str:
    """All statistics, and the share of customers in each of the eight most frequent levels."""
    keys = apart + "country"
    return f"""SELECT {keys}, feature, value FROM (UNPIVOT (SELECT {keys}, {_CAST} FROM {source})
  ON {', '.join(VECTOR_STATS)} INTO NAME feature VALUE value)
UNION ALL SELECT {keys}, 'mix_' || level AS feature, coalesce(n, 0) / size AS value
FROM (SELECT {keys}, count(*) AS size FROM {customers} GROUP BY {keys})
JOIN (SELECT {apart} 0 AS zero, coalesce(segment, 'UNK') AS level FROM {customers} GROUP BY {apart} level
      QUALIFY row_number() OVER ({'PARTITION BY ' + apart.rstrip(', ') if apart else ''} ORDER BY count(*) DESC, level) <= 8) t
  {f"USING ({apart.rstrip(', ')})" if apart else "ON zero = 0"}
LEFT JOIN (SELECT {keys}, coalesce(segment, 'UNK') AS level, count(*) AS n FROM {customers} GROUP BY {keys}, level)
  USING ({keys}, level)"""


def z_sql(source: str, part: str) -> str:
    return f"""
SELECT *, coalesce((value - avg(value) OVER w) / CASE WHEN stddev_pop(value) OVER w > 1e-12
  THEN stddev_pop(value) OVER w END, 0) AS z FROM {source} WINDOW w AS (PARTITION BY {part})"""


def pairs_sql(source: str, keys: str = "") -> str:
    return f"""
SELECT {keys} a.country, b.country AS neighbor, sqrt(sum(pow(a.z - b.z, 2))) AS dist_eucl,
  1 - coalesce(sum(a.z * b.z) / nullif(sqrt(sum(a.z * a.z)) * sqrt(sum(b.z * b.z)), 0), 0) AS dist_cos
FROM {source} a JOIN {source} b USING ({keys} feature) WHERE a.country <> b.country
GROUP BY {keys} a.country, b.country"""


sv.view("vec_long", "vector segments", long_sql("vector", "segments"))
sv.view("zs", "vec_long", z_sql("vec_long", "feature"))
sv.view("pairs", "zs", pairs_sql("zs"))
_RANK = "row_number() OVER (PARTITION BY country ORDER BY round({m}, 12), neighbor)"


def vector_long(rows, keys):
    return profile.behaviour_long(profile.country_vector(rows, keys), profile.mix_features(rows, "segment", keys), keys)


def zs_of(spark, path):
    return stored(sim.standardized(vector_long(stored(segmented(spark, path)), ["country"])))


def pairs_of(spark, path):
    return sim.pairwise(zs_of(spark, path))


@query("f10_median_impute", uses="country_stats", spec="value:6", sql="""
WITH_LONG""".replace("WITH_LONG", """
SELECT country, feature, coalesce(value, median(value) OVER (PARTITION BY feature)) AS value FROM (
  SELECT country, unnest(['p2p_keep_rate', 'dpd_std']) AS feature,
    unnest([CASE WHEN n_customers % 3 = 0 THEN NULL ELSE p2p_keep_rate END, dpd_std]) AS value FROM country_stats)"""))
def _(spark, path):
    stats = profile.country_profile(typed(spark, path))
    wide = stats.select("country", F.when(F.col("n_customers") % 3 != 0, F.col("p2p_keep_rate"))
                        .alias("p2p_keep_rate"), "dpd_std")
    long = wide.select("country", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"))
        for c in ("p2p_keep_rate", "dpd_std")])))
    return sim.median_imputed(long)


@query("g01_standardized_vectors", uses="zs", spec="value:4 z:6",
       sql="SELECT country, feature, value, z FROM zs")
def _(spark, path):
    return zs_of(spark, path)


@query("g02_euclidean_distances", uses="pairs", spec="dist_eucl:6",
       sql="SELECT country, neighbor, dist_eucl FROM pairs")
def _(spark, path):
    return pairs_of(spark, path).select("country", "neighbor", "dist_eucl")


@query("g03_cosine_distances", uses="pairs", spec="dist_cos:6",
       sql="SELECT country, neighbor, dist_cos FROM pairs")
def _(spark, path):
    return pairs_of(spark, path).select("country", "neighbor", "dist_cos")


@query("j15_country_pairs", uses="zs", sql="""
SELECT a.country, b.country AS neighbor FROM (SELECT DISTINCT country FROM zs) a
JOIN (SELECT DISTINCT country FROM zs) b ON a.country <> b.country""")
def _(spark, path):
    return pairs_of(spark, path).select("country", "neighbor")


sv.view("near5", "pairs", f"""
SELECT country, neighbor, dist_eucl AS distance, {_RANK.format(m='dist_eucl')} AS rank FROM pairs
QUALIFY rank <= 5""")


@query("w14_top_k_neighbors", uses="near5", spec="distance:6", sql="""
SELECT country, neighbor, CAST(rank AS INTEGER) AS rank, distance FROM near5""")
def _(spark, path):
    return sim.nearest(pairs_of(spark, path), 5)


@query("g04_dual_metric_neighbors", uses="pairs", spec="distance:6", sql=" UNION ALL ".join(
    f"""SELECT country, neighbor, CAST(rank AS INTEGER) AS rank, distance, '{m}' AS metric FROM (
  SELECT country, neighbor, {m} AS distance, {_RANK.format(m=m)} AS rank FROM pairs) WHERE rank <= 3"""
    for m in ("dist_eucl", "dist_cos")))
def _(spark, path):
    return sim.neighbor_table(stored(pairs_of(spark, path)), 3)


def routing_sql(candidates: str) -> str:
    return f"""
SELECT v.country, v.n_customers, max(neighbor) FILTER (r = 1) AS donor_country,
  max(distance) FILTER (r = 1) AS donor_dist, max(neighbor) FILTER (r = 2) AS runner_up,
  max(distance) FILTER (r = 2) AS runner_up_dist
FROM vector v LEFT JOIN (SELECT c.*, row_number() OVER (PARTITION BY c.country
    ORDER BY round(distance, 12), neighbor) AS r FROM {candidates} c
  JOIN vector b ON b.country = c.neighbor AND b.n_customers >= 58) c ON c.country = v.country
WHERE v.n_customers < 58 GROUP BY 1, 2"""


_ROUTE_SPEC = "donor_dist:6 runner_up_dist:6"
sv.view("all_pairs", "pairs", "SELECT country, neighbor, dist_eucl AS distance FROM pairs")
sv.view("donors", "vector all_pairs", routing_sql("all_pairs"))


def _parts(spark, path):
    rows = stored(segmented(spark, path))
    vector = stored(profile.country_vector(rows))
    zs = stored(sim.standardized(profile.behaviour_long(vector, profile.mix_features(rows, "segment"))))
    pairs = stored(sim.pairwise(zs))
    return vector, zs, pairs


@query("g05_donor_routing_all_pairs", uses="donors", spec=_ROUTE_SPEC, sql="SELECT * FROM donors")
def _(spark, path):
    vector, _zs, pairs = _parts(spark, path)
    return sim.donor_routing(pairs.withColumnRenamed("dist_eucl", "distance"), vector, 58)


@query("g05_donor_routing_within_top_k", uses="vector near5", spec=_ROUTE_SPEC,
       sql=routing_sql("near5"))
def _(spark, path):
    vector, _zs, pairs = _parts(spark, path)
    return sim.donor_routing(sim.nearest(pairs, 5), vector, 58)


@query("g06_proxy_models", uses="vector near5", spec="distance:6", sql="""
SELECT v.country, arg_min(n.neighbor, (round(n.distance, 12), n.neighbor)) AS proxy_country,
  min(n.distance) AS distance FROM vector v LEFT JOIN (SELECT * FROM near5 WHERE neighbor IN
  (SELECT country FROM vector WHERE n_customers % 4 = 0)) n USING (country)
WHERE v.n_customers % 2 = 1 GROUP BY v.country""")
def _(spark, path):
    vector, _zs, pairs = _parts(spark, path)
    n = F.col("n_customers")
    return sim.proxy_models(
        sim.nearest(pairs, 5), vector.filter(n % 2 == 1), vector.filter(n % 4 == 0))


sv.view("labels3", "vector", """
SELECT country, CAST(CAST(replace(country, 'NATION_', '') AS INTEGER) % 3 AS INTEGER) AS cluster FROM vector""")


def labels_of(zs):
    number = F.regexp_replace("country", "NATION_", "").cast("int")
    return zs.select("country").distinct().withColumn("cluster", number % 3)


sv.view("sil", "pairs labels3", """
SELECT country, cluster, a, b, coalesce((b - a) / greatest(a, b), 0) AS silhouette FROM (
  SELECT country, cluster, max(d) FILTER (cluster = other) AS a, min(d) FILTER (cluster <> other) AS b FROM (
    SELECT p.country, l.cluster, o.cluster AS other, avg(dist_eucl) AS d FROM pairs p
    JOIN labels3 l ON l.country = p.country JOIN labels3 o ON o.country = p.neighbor GROUP BY ALL)
  GROUP BY country, cluster)""")


@query("g11_silhouette_per_country", uses="sil", spec="a:6 b:6 silhouette:6", sql="SELECT * FROM sil")
def _(spark, path):
    zs = zs_of(spark, path)
    return sim.silhouettes(sim.pairwise(zs), labels_of(zs))


@query("g10_clustering_score_given_labels", uses="sil", spec="silhouette:6 balance:6 score:6", sql="""
SELECT *, silhouette - 0.15 * (1 - balance) AS score FROM (
  SELECT count(*) AS k, sum(s) / sum(n) AS silhouette, min(n) AS smallest, min(n) / max(n) AS balance
  FROM (SELECT cluster, count(*) AS n, sum(silhouette) AS s FROM sil GROUP BY cluster))""")
def _(spark, path):
    zs = zs_of(spark, path)
    return sim.clustering_score(sim.silhouettes(sim.pairwise(zs), labels_of(zs)))


@query("g14_cluster_profile", uses="zs labels3", spec="mean_z:6", sql="""
SELECT cluster, feature, avg(z) AS mean_z FROM zs JOIN labels3 USING (country) GROUP BY 1, 2""")
def _(spark, path):
    zs = zs_of(spark, path)
    return sim.cluster_profile(zs, labels_of(zs))


_GAPS = """(SELECT a.feature, abs(a.z - b.z) AS gap FROM zs a JOIN zs b USING (feature)
  WHERE a.country = 'NATION_3' AND b.country = 'NATION_8')"""


@query("g15_why_similar", uses="zs", spec="gap:6", sql=f"""
(SELECT feature, gap, 'closest' AS side FROM {_GAPS} ORDER BY round(gap, 12), feature LIMIT 10)
UNION ALL (SELECT feature, gap, 'farthest' AS side FROM {_GAPS} ORDER BY round(gap, 12) DESC, feature LIMIT 10)""")
def _(spark, path):
    return sim.why_similar(zs_of(spark, path), "NATION_3", "NATION_8", 10)


@query("g17_distance_matrix", uses="pairs", spec="NATION_0:6 NATION_1:6 NATION_2:6", sql="""
SELECT country, coalesce(max(dist_eucl) FILTER (neighbor = 'NATION_0'), 0) AS "NATION_0",
  coalesce(max(dist_eucl) FILTER (neighbor = 'NATION_1'), 0) AS "NATION_1",
  coalesce(max(dist_eucl) FILTER (neighbor = 'NATION_2'), 0) AS "NATION_2" FROM pairs GROUP BY country""")
def _(spark, path):
    return sim.distance_matrix(pairs_of(spark, path), ["NATION_0", "NATION_1", "NATION_2"])


@query("g19_cluster_overview", uses="vector labels3", sql="""
SELECT cluster, country, n_customers FROM vector JOIN labels3 USING (country)""")
def _(spark, path):
    vector = profile.country_vector(stored(customers(spark, path)))
    return sim.cluster_overview(labels_of(vector), vector)


RUNS = 50
_KEEP = "(CAST(customer_id AS BIGINT) * 7919 + r * 104729) % 1000 < 700"
sv.view("boot", "segments", f"""
SELECT segments.*, r FROM segments CROSS JOIN (SELECT CAST(unnest(range(1, {RUNS + 1})) AS INTEGER) AS r) WHERE {_KEEP}""")
sv.view("boot_vec", "boot", vector_sql("boot", "r, country"))
sv.view("boot_long", "boot_vec boot", long_sql("boot_vec", "boot", "r, "))
sv.view("boot_z", "boot_long", z_sql("boot_long", "r, feature"))
sv.view("boot_pairs", "boot_z", pairs_sql("boot_z", "r,"))
sv.view("boot_stability", "boot_pairs pairs", f"""
SELECT b.country, b.neighbor AS baseline_top1,
  avg(CASE WHEN t.neighbor = b.neighbor THEN 1 ELSE 0 END) AS agreement_rate, count(t.r) AS runs
FROM (SELECT country, neighbor FROM pairs QUALIFY {_RANK.format(m='dist_eucl')} = 1) b
JOIN (SELECT r, country, neighbor FROM boot_pairs QUALIFY row_number() OVER (
  PARTITION BY r, country ORDER BY round(dist_eucl, 12), neighbor) = 1) t USING (country) GROUP BY 1, 2""")


def stability_of(spark, path):
    r, number = F.col("r"), F.col("customer_id").cast("bigint")
    keep = (number * 7919 + r * 104729) % 1000 < 700
    return sim.bootstrap_stability(stored(segmented(spark, path)), vector_long, RUNS, keep)


@query("g13_bootstrap_stability", uses="boot_stability", spec="agreement_rate:6",
       sql="SELECT * FROM boot_stability")
def _(spark, path):
    return stability_of(spark, path)


@query("g16_donor_confidence", uses="donors boot_stability", spec=_ROUTE_SPEC + " agreement_rate:6",
       sql="""SELECT d.*, agreement_rate, CASE WHEN coalesce(agreement_rate, 0) < 0.5 THEN 1 ELSE 0 END AS low_confidence
FROM donors d LEFT JOIN boot_stability USING (country)""")
def _(spark, path):
    vector, _zs, pairs = _parts(spark, path)
    routing = sim.donor_routing(pairs.withColumnRenamed("dist_eucl", "distance"), vector, 58)
    return sim.donor_confidence(routing, stability_of(spark, path))


@query("g07_principal_components")
def _(spark, path):
    return sim.principal_components(zs_of(spark, path), 0.9)


@query("g08_kmeans_segments")
def _(spark, path):
    return sim.kmeans(zs_of(spark, path), 4)


@query("g09_hierarchical_segments")
def _(spark, path):
    return sim.bisecting(zs_of(spark, path), 4)


@query("g12_clustering_candidates")
def _(spark, path):
    return sim.cluster_candidates(zs_of(spark, path), 2, 8)


@query("g18_behaviour_map")
def _(spark, path):
    vector, zs, _pairs = _parts(spark, path)
    return sim.behaviour_map(zs, vector)


def tree_of(spark, path, method="ward"):
    zs = zs_of(spark, path)
    pairs = stored(sim.pairwise(zs))
    return zs, pairs, linkage.merges(pairs, method)


@query("g09_ward_merges", uses="zs", spec="squared_error:5", sql="""
SELECT count(DISTINCT country) - 1 AS merges, sum(z * z) AS squared_error, count(DISTINCT country) AS largest FROM zs""")
def _(spark, path):
    """n - 1 merges, the last of all countries; half the squared heights add up to the squared error
    of everything in one cluster."""
    _zs, _pairs, tree = tree_of(spark, path)
    return tree.agg(F.count("*").alias("merges"), F.sum(F.pow("height", F.lit(2.0)) / 2).alias("squared_error"), F.max("size").alias("largest"))


@query("g09_ward_segments", uses="zs", sql="""
SELECT k, count(DISTINCT country) AS countries, k AS clusters, 0 AS off FROM zs CROSS JOIN (SELECT unnest([2, 4, 7]) AS k) GROUP BY k""")
def _(spark, path):
    """Labels at k: k clusters, and the squared error within them is what the merges made add up to."""
    zs, _pairs, tree = tree_of(spark, path)
    out = None
    for k in (2, 4, 7):
        found = linkage.labels(tree, zs, k)
        spread = zs.join(found, "country").groupBy("cluster", "feature").agg(
            (F.sum(F.col("z") * F.col("z")) - F.sum("z") * F.sum("z") / F.count("*")).alias("e"))
        heights = F.slice(F.array_sort(F.collect_list("height")), F.lit(1), F.count("*").cast("int") + 1 - k)
        made = tree.agg(F.aggregate(heights, F.lit(0.0), lambda s, h: s + h * h / 2)).scalar()
        row = found.agg(F.lit(k).alias("k"), F.count("*").alias("countries"), F.count_distinct("cluster").alias("clusters"),
                        (F.abs(spread.agg(F.sum("e")).scalar() - made) > 1e-6).cast("int").alias("off"))
        out = row if out is None else out.unionByName(row)
    return out


@query("g12_cophenetic_distances", uses="zs", sql="""
SELECT method, count(DISTINCT country) * (count(DISTINCT country) - 1) AS pairs, 0 AS not_ultrametric, 1 AS in_range
FROM zs CROSS JOIN (SELECT unnest(['ward', 'average', 'complete']) AS method) GROUP BY method""")
def _(spark, path):
    """Of three countries the two longest cophenetic distances are equal, and the correlation with
    the distances is one."""
    zs = zs_of(spark, path)
    pairs, out = stored(sim.pairwise(zs)), None
    for method in linkage.METHODS:
        tree = linkage.merges(pairs, method)
        kept = stored(linkage.cophenetic(tree))
        a, b, c = (kept.alias(n) for n in "abc")
        three = a.join(b, F.col("a.neighbor") == F.col("b.country")).join(
            c, (F.col("c.country") == F.col("a.country")) & (F.col("c.neighbor") == F.col("b.neighbor")))
        broken = three.where(F.col("c.height") > F.greatest("a.height", "b.height") + 1e-9).agg(F.count("*")).scalar()
        faithful = linkage.cophenetic_correlation(tree, pairs)
        row = kept.agg(F.lit(method).alias("method"), F.count("*").alias("pairs"), broken.alias("not_ultrametric"),
                       faithful.between(-1, 1).cast("int").alias("in_range"))
        out = row if out is None else out.unionByName(row)
    return out


@query("g12_candidate_scores", uses="zs", sql="""
SELECT method, k AS requested_k, 1 AS in_range, 1 AS scored, 1 AS ranked_in_order
FROM (SELECT unnest(['kmeans', 'bisecting', 'ward', 'average', 'complete']) AS method) CROSS JOIN (SELECT unnest(range(2, 9)) AS k)""")
def _(spark, path):
    """Every method and k is scored by silhouette + 0.3 cophenetic - 0.15 imbalance, or -1."""
    found = stored(sim.cluster_candidates(zs_of(spark, path), 2, 8))
    fair = (F.col("k") >= 2) & (F.col("smallest") >= 2)
    want = F.when(fair, F.col("silhouette") + 0.3 * F.col("cophenetic") - 0.15 * (1 - F.col("balance"))).otherwise(-1.0)
    order = found.agg(F.array_sort(F.collect_list(F.struct(-F.col("silhouette"), "requested_k", "method")))).scalar()
    at = F.element_at(order, F.col("rank"))
    return found.select("method", "requested_k", F.col("silhouette").between(-1, 1).cast("int").alias("in_range"),
                        (F.abs(F.col("score") - want) < 1e-9).cast("int").alias("scored"),
                        ((at["method"] == F.col("method")) & (at["requested_k"] == F.col("requested_k"))).cast("int").alias("ranked_in_order"))


@query("g08_kmeans_settled", uses="zs", sql="SELECT DISTINCT country, 1 AS in_nearest FROM zs")
def _(spark, path):
    """Each country is in the cluster whose mean is nearest to it."""
    zs = zs_of(spark, path)
    found = sim.kmeans(zs, 4)
    means = zs.join(found, "country").groupBy("cluster", "feature").agg(F.avg("z").alias("m"))
    away = zs.join(means, "feature").groupBy("country", F.col("cluster").alias("other")).agg(F.sum(F.pow(F.col("z") - F.col("m"), 2)).alias("d"))
    best = away.groupBy("country").agg(F.min("d").alias("least"))
    own = away.join(found, "country").where("other = cluster").join(best, "country")
    return own.select("country", (F.col("d") <= F.col("least") + 1e-9).cast("int").alias("in_nearest"))


@query("g07_components_keep_variance", uses="zs", spec="variance:6", sql="""
SELECT sum(z * z) / count(DISTINCT country) AS variance, 1 AS falling, 1 AS shares_add_up FROM zs""")
def _(spark, path):
    """All components together keep the variance of all features, in falling order."""
    zs = zs_of(spark, path)
    found = sim.principal_components(zs, 2.0)
    each = found.groupBy("component").agg(F.sum(F.pow("value", F.lit(2.0))).alias("v"), F.max("explained").alias("share"), F.count("*").alias("n"))
    order = F.transform(F.array_sort(F.collect_list(F.struct("component", "v"))), lambda s: -F.round(s["v"], 6))
    return each.agg(F.sum(F.col("v") / F.col("n")).alias("variance"), (order == F.array_sort(order)).cast("int").alias("falling"),
                    (F.abs(F.sum("share") - 1) < 1e-9).cast("int").alias("shares_add_up"))


@query("g18_map_of_two_components", uses="vector", sql="SELECT country, n_customers, 1 AS same FROM vector")
def _(spark, path):
    """The map holds the first two components of each country, with their shares."""
    vector, zs, _pairs = _parts(spark, path)
    found = sim.behaviour_map(zs, vector)
    both = sim.principal_components(zs, exactly=2).groupBy("country").agg(
        F.array_sort(F.collect_list(F.struct("component", "value", "explained"))).alias("c"))
    same = [F.abs(F.col(f"{n}{i + 1}") - F.col("c")[i][f]) < 1e-9 for i in (0, 1) for n, f in (("pc", "value"), ("explained", "explained"))]
    return found.join(both, "country").select("country", "n_customers", (same[0] & same[1] & same[2] & same[3]).cast("int").alias("same"))
