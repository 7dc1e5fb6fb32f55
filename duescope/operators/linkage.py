"""Agglomerative clustering over a table of pairs: merge table, labels at k, cophenetic distances.

In each round all reciprocal nearest neighbours merge at once, which gives the dendrogram of one
merge at a time for the three linkages here (joining two clusters never brings them nearer to a
third). A merged cluster goes on under the smaller name of its two, so the merge table is a
forest of pointers from the name that ends to the name that stays, with the height of the merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.storage import stored

METHODS = ("ward", "average", "complete")


def _collapsed(pairs: DataFrame, merged: DataFrame, method: str) -> DataFrame:
    """`pairs` (a, b, d, n_a, n_b) with the `merged` (lo, hi, own, size) put together on the a side."""
    part = merged.select(F.explode(F.array("lo", "hi")).alias("a"), F.col("lo").alias("to"), "own", "size")
    moved = pairs.join(part, "a", "left").select(
        F.coalesce("to", "a").alias("a"), "b", "d", "n_a", "n_b", F.coalesce("size", "n_a").alias("n"), F.coalesce("own", F.lit(0.0)).alias("own"))
    n, d = F.col("n_a"), F.col("d")
    rest = F.max("n_b")
    joint = {
        "ward": (F.sum((n + F.col("n_b")) * d) - F.when(F.count("*") > 1, rest * F.max("own")).otherwise(0.0)) / (F.sum(n) + rest),
        "average": F.sum(n * d) / F.sum(n),
        "complete": F.max(d)}[method]
    return moved.where(F.col("a") != F.col("b")).groupBy("a", "b").agg(
        joint.alias("d"), F.max("n").alias("n_a"), rest.alias("n_b"))


def _turned(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "d", F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b"))


def merges(pairs: DataFrame, method: str = "ward") -> DataFrame:
    """(lo, hi, height, size): the n - 1 merges of the entities in `pairs` (country, neighbor,
    dist_eucl: both directions of every pair); `lo` goes on, `hi` ends. Equal distances go by name.

    Heights of ward are the roots of twice the growth of the squared errors.
    """
    if method not in METHODS:
        raise ValueError(f"linkage is one of {', '.join(METHODS)}")
    start = F.pow("dist_eucl", F.lit(2.0)) if method == "ward" else F.col("dist_eucl")
    left = stored(pairs.select(F.col("country").alias("a"), F.col("neighbor").alias("b"), start.alias("d"),
                               F.lit(1).cast("long").alias("n_a"), F.lit(1).cast("long").alias("n_b")))
    done = None
    while not left.isEmpty():
        edge = F.struct("d", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), (F.col("n_a") + F.col("n_b")).alias("size"))
        nearest = left.groupBy("a").agg(F.min(edge).alias("e")).select("e.*")
        both = nearest.groupBy("lo", "hi").agg(F.count("*").alias("sides"), F.max("d").alias("own"), F.max("size").alias("size"))
        merged = stored(both.where("sides = 2").drop("sides"))
        done = merged if done is None else done.unionByName(merged)
        # first one side of each pair, then, with the new sizes, the other
        left = stored(_turned(_collapsed(_turned(_collapsed(left, merged, method)), merged, method)))
    if done is None:
        return pairs.select(F.col("country").alias("lo"), F.col("neighbor").alias("hi"), F.col("dist_eucl").alias("height"),
                            F.lit(1).cast("long").alias("size")).limit(0)
    height = F.sqrt("own") if method == "ward" else F.col("own")
    return stored(done.select("lo", "hi", height.alias("height"), "size"))


def labels_at(table: DataFrame, entities: DataFrame, ks: list[int]) -> DataFrame:
    """(k, country, cluster) for each k: the clusters left when the n - k lowest merges of `table`
    are made, numbered from 0 by their smallest names."""
    order = Window.partitionBy(F.lit(0)).orderBy("height", "lo", "hi")
    n = table.agg(F.count("*")).scalar() + 1
    tried = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    made = table.withColumn("_n", F.row_number().over(order)).select("*", tried).where(F.col("_n") <= n - F.col("k"))
    up = stored(entities.select(F.col("country").alias("node")).distinct().select("node", tried).join(
        made.select("k", F.col("hi").alias("node"), F.col("lo").alias("to")), ["k", "node"], "left").select("k", "node", F.coalesce("to", "node").alias("to")))
    while True:
        x, y = up.alias("x"), up.alias("y")
        after = stored(x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.to") == F.col("y.node"))).select(
            "x.k", "x.node", "y.to", (F.col("x.to") != F.col("y.to")).alias("moved")))
        if after.where("moved").isEmpty():
            break
        up = after.drop("moved")
    number = F.dense_rank().over(Window.partitionBy("k").orderBy("to")) - 1
    return up.select("k", F.col("node").alias("country"), number.cast("int").alias("cluster"))


def labels(table: DataFrame, entities: DataFrame, k: int) -> DataFrame:
    """(country, cluster) at one k."""
    return labels_at(table, entities, [k]).drop("k")


def cophenetic(table: DataFrame) -> DataFrame:
    """(country, neighbor, height): the height at which two entities first share a cluster, in both
    directions: the greatest height on the way through the pointers of the merge table."""
    up = table.select(F.col("hi").alias("node"), F.col("lo").alias("to"), "height")
    names = table.select(F.explode(F.array("lo", "hi")).alias("node")).distinct()
    reach = stored(names.select("node", F.col("node").alias("to"), F.lit(0.0).alias("height")).unionByName(up))
    while True:  # ways of twice the length each time
        a, b = reach.alias("a"), reach.alias("b")
        longer = a.join(b, F.col("a.to") == F.col("b.node")).select(
            F.col("a.node"), F.col("b.to"), F.greatest("a.height", "b.height").alias("height"))
        after = stored(longer.groupBy("node", "to").agg(F.min("height").alias("height")))
        if after.count() == reach.count():  # no way was left to be added
            break
        reach = after
    x, y = reach.alias("x"), reach.alias("y")
    met = x.join(y, F.col("x.to") == F.col("y.to")).where(F.col("x.node") != F.col("y.node"))
    return met.groupBy(F.col("x.node").alias("country"), F.col("y.node").alias("neighbor")).agg(
        F.min(F.greatest("x.height", "y.height")).alias("height"))


def cophenetic_correlation(table: DataFrame, pairs: DataFrame) -> Column:
    """Scalar: how faithfully the tree keeps the distances."""
    both = cophenetic(table).join(pairs, ["country", "neighbor"])
    return both.agg(F.try_divide(F.covar_pop("height", "dist_eucl"), F.stddev_pop("height") * F.stddev_pop("dist_eucl"))).scalar()
