"""Quality rules: base limits, then robust multivariate outliers per language and source.

Every document becomes a vector of transformed statistics. Location and scatter of each
(language, source) are the minimum-covariance-determinant estimate: starting from medians and
quartiles, concentration steps refit them on the three quarters of the documents that are
nearest in Mahalanobis distance, which never raises the determinant; one reweighting step
follows. A step is one aggregation: documents are summed up by (group, distance bin), the
bins of a group are taken in order until they hold three quarters, and their sums give mean and
covariance. A group of any size is summed before the shuffle. The inverse is never formed:
distances come from a Cholesky factor written as column expressions.

Estimates are blended with those of their language as with PRIOR further documents, and
variances have floors, so small or constant groups need no case of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duescope.llm.common import row_key, without
from duescope.llm.textstats import with_statistics
from duescope.storage import stored

MIN_WORDS, MAX_REPEAT = 10, 20  # base limits: words; percent of words in repeated windows
SHARE = 0.75  # of a group that a concentration step keeps
STEPS = 4
PRIOR = 50.0
OUTSIDE = 1e-9  # chance beyond the cut of a normal vector
GROUP = ["g_lang", "g_source"]
PER_FILE = 5_000  # groups in a file of estimates, so that their size tells Spark how to join them
#: The vector: name, and the least standard deviation it is given.
VECTOR = {"size": 1.0, "word_length": 1.0, "symbols": 0.035, "dup_lines": 0.1, "repeats": 0.1, "upper": 0.06}
DIM = len(VECTOR)
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def chi2(x: float, d: int) -> float:
    """P(chi-squared with an even number `d` of degrees of freedom <= x)."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2(mid, d) < p else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """Makes the covariance of the nearest `share` of normal vectors that of all of them."""
    return share / chi2(chi2_quantile(share, DIM), DIM + 2)


def vector() -> list[Column]:
    """The transformed statistics, on a grid of 1/128 so that equal documents tie exactly."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    raw = [F.log1p("n_words"), F.sqrt(F.col("word_chars") / n) * 2, F.sqrt(F.col("n_symbols") / F.greatest("n_chars", F.lit(1))),
           F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n),
           F.sqrt(F.col("n_upper") / F.greatest("n_chars", F.lit(1)))]
    return [(F.round(c * 128) / 128).alias(f"x{i}") for i, c in enumerate(raw)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, group, base statistics, base_failed and the vector of every row."""
    keep = [F.col("doc_id"), row_key(docs, ["doc_id", "text", "lang", "source"]).alias("row_key"),
            *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(f"g_{c}") for c in ("lang", "source")]]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return with_statistics(docs, keep).select("doc_id", "row_key", *GROUP, *base, failed.alias("base_failed"), *vector())


def _factor(cov: dict[tuple[int, int], Column]) -> dict[tuple[int, int], Column]:
    """Columns of the Cholesky factor; each is computed once, row by row, by `_estimates`."""
    out = {}
    for i, j in PAIRS:
        rest = cov[i, j]
        for k in range(j):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        out[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}_{j}")
    return out


def _kept(estimates: DataFrame, groups: int) -> DataFrame:
    return stored(estimates.repartition(1 + groups // PER_FILE))


def _estimates(sums: DataFrame, factor: float, groups: int) -> DataFrame:
    """Group, mean m{i} and Cholesky factor l{i}_{j} from n, s{i} and s{i}_{j} per group."""
    names = ["n", *[f"s{i}" for i in range(DIM)], *[f"s{i}_{j}" for i, j in PAIRS]]
    by_lang = sums.groupBy("g_lang").agg(*[F.sum(c).alias(f"lang_{c}") for c in names])
    both = sums.join(by_lang, "g_lang")
    # sums of the group plus PRIOR documents that are like its language's average document
    mixed = both.select(*GROUP, (F.col("n") + PRIOR).alias("n"), *[
        (F.col(c) + PRIOR * F.col(f"lang_{c}") / F.col("lang_n")).alias(c) for c in names[1:]])
    out = mixed.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(DIM)})
    floors = [f ** 2 for f in VECTOR.values()]
    cov = {(i, j): factor * (F.col(f"s{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) + (floors[i] if i == j else 0.0)
           for i, j in PAIRS}
    for (i, j), c in _factor(cov).items():
        out = out.withColumn(f"l{i}_{j}", c)
    return _kept(out.select(*GROUP, *[f"m{i}" for i in range(DIM)], *[f"l{i}_{j}" for i, j in PAIRS]), groups)


def _start(rows: DataFrame, groups: int) -> DataFrame:
    """Medians, and quartile distances as standard deviations. Values lie on a grid, so the
    exact percentiles keep a bounded number of counts per group."""
    q = rows.groupBy(*GROUP).agg(*[F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(DIM)])
    return _kept(q.select(*GROUP, *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIM)], *[
        (F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(floor)) if i == j else F.lit(0.0)).alias(f"l{i}_{j}")
        for (i, j) in PAIRS for floor in [list(VECTOR.values())[i]]]), groups)


def with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """`rows` with `d2`, the squared Mahalanobis distance under its group's estimate."""
    out = rows.join(estimates, GROUP)
    for i in range(DIM):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM)), F.lit(0.0))
    return out.select(*rows.columns, d2.alias("d2"))


def _step(rows: DataFrame, estimates: DataFrame, within: float | None, groups: int) -> DataFrame:
    """Estimates from the nearest SHARE of each group, or from all at distance `within` or less."""
    far = with_distance(rows, estimates).withColumn("bin", F.floor(8 * F.log2(F.col("d2") + 0.001)).cast("int"))
    moments = {f"s{i}": F.sum(f"x{i}") for i in range(DIM)} | {f"s{i}_{j}": F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in PAIRS}
    bins = (far if within is None else far.where(F.col("d2") <= within)).groupBy(*GROUP, "bin").agg(
        F.count("*").cast("double").alias("n"), *[c.alias(k) for k, c in moments.items()])
    if within is None:
        by = Window.partitionBy(*GROUP)
        nearer = F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        bins = stored(bins)  # summed up by (group, bin) first; only bins of a group meet in its window
        bins = bins.withColumns({"nearer": F.coalesce(nearer, F.lit(0.0)), "all": F.sum("n").over(by)})
        bins = bins.where(F.col("nearer") < SHARE * F.col("all"))
    sums = bins.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in ("n", *moments)])
    return _estimates(sums, consistency(SHARE) if within is None else consistency(0.975), groups)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, base statistics, base_failed, d2 and kept for every row of `docs`
    (doc_id, text, lang, source).

    Null text has no words; null language and source count as empty names. Documents that fail
    the base limits don't shape the estimates and are never kept; their d2 is null. Repeated rows
    count each. An empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(statistics(docs))
    sound = rows.where(~F.col("base_failed"))
    groups = sound.select(*GROUP).distinct().count()
    estimates = _start(sound, groups)
    for _ in range(STEPS):
        estimates = _step(sound, estimates, None, groups)
    estimates = _step(sound, estimates, chi2_quantile(0.975, DIM), groups)
    cut = chi2_quantile(1 - OUTSIDE, DIM)
    final = with_distance(sound, estimates).withColumn("kept", F.col("d2") <= cut)
    failed = rows.where("base_failed").withColumns({"d2": F.lit(None).cast("double"), "kept": F.lit(False)})
    return final.unionByName(failed).drop(*[f"x{i}" for i in range(DIM)], *GROUP)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with the columns of `docs`."""
    bad = judged(docs).where(~F.col("kept"))
    return without(docs, bad, row_key(docs, ["doc_id", "text", "lang", "source"]))
