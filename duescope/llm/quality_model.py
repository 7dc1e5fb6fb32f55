"""Quality as a sparse rule ensemble.

Shallow boosted trees over text statistics are fitted on labelled rows; each path of a tree is
a conjunction of bounds, a rule. A lasso logistic regression over the rules and the statistics
keeps the few that matter. What is left is compiled into one Spark column expression: scoring
runs no Python and moves no text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.llm.labelled import FIT_ROWS, fit_rows
from duescope.llm.textstats import with_statistics
from duescope.storage import stored

TREES, DEPTH = 20, 3
LASSO = 0.002
KEEP = 0.3  # documents with a score under it go


def measures() -> dict[str, Column]:
    """Statistics that rules are about, from the columns of `with_statistics`."""
    def per(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "words": F.log1p("n_words"), "word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"), "upper": per("n_upper", "word_chars"),
        "stops": per("n_stops", "n_words"), "line_words": F.log1p(per("n_words", "n_lines")),
    }


@dataclass(frozen=True)
class Bound:
    """measure <= at, or > at."""

    measure: str
    at: float
    above: bool

    def column(self) -> Column:
        return F.col(self.measure) > self.at if self.above else F.col(self.measure) <= self.at


Rule = frozenset[Bound]


def _tightest(bounds: list[Bound]) -> Rule:
    best: dict[tuple[str, bool], Bound] = {}
    for b in bounds:
        old = best.get((b.measure, b.above))
        if old is None or (b.at > old.at) == b.above:
            best[b.measure, b.above] = b
    return frozenset(best.values())


def paths(node, names: list[str], above: tuple[Bound, ...] = ()) -> list[Rule]:
    """Rules of all nodes below the root of a Spark ML tree (its JVM node)."""
    out = [_tightest(list(above))] if above else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = names[split.featureIndex()], float(split.threshold())
        out += paths(node.leftChild(), names, (*above, Bound(name, at, False)))
        out += paths(node.rightChild(), names, (*above, Bound(name, at, True)))
    return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    linear: dict[str, float]
    rules: dict[Rule, float]

    def score(self) -> Column:
        """The chance of label 1 as a column over the columns of `measures`."""
        logit = F.lit(self.intercept)
        for name, w in self.linear.items():
            logit = logit + w * F.col(name)
        for rule, w in self.rules.items():
            test = F.lit(True)
            for b in sorted(rule, key=lambda b: (b.measure, b.above)):
                test = test & b.column()
            logit = logit + F.when(test, F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), logit))))


def _measured(docs: DataFrame, keep: list[Column]) -> DataFrame:
    stats = with_statistics(docs, keep)
    kept = [c for c in stats.columns if c not in _STATISTICS]
    return stats.select(*kept, *[c.cast("double").alias(n) for n, c in measures().items()])


_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_lines", "n_stops")


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> RuleModel:
    """The ensemble for `labels` (doc_id, quality) on about `rows` labelled rows of `docs`
    (doc_id, text). With labels of one kind only, or none, a constant (without any: one half)."""
    fit = fit_rows(docs, labels, "quality", rows)
    known = _measured(fit, [F.col("y")])
    n, share = known.agg(F.count("*"), F.avg("y")).first()
    if not n or share in (0.0, 1.0):
        p = 0.5 if not n else (share * n + 0.5) / (n + 1)
        return RuleModel(math.log(p / (1 - p)), {}, {})
    names = list(measures())
    # a few hundred jobs go over the fit's rows, a few MB: one task each takes less than dealing them out
    known = stored(known).coalesce(max(1, round(rows / FIT_ROWS)))
    table = stored(VectorAssembler(inputCols=names, outputCol="x").transform(known))
    trees = GBTClassifier(featuresCol="x", labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, subsamplingRate=0.7, seed=8).fit(table)
    rules = sorted({r for t in trees.trees for r in paths(t._call_java("rootNode"), names)}, key=lambda r: sorted(map(repr, r)))
    tests = []
    for k, rule in enumerate(rules):
        test = F.lit(True)
        for b in rule:
            test = test & b.column()
        tests.append(test.cast("double").alias(f"r{k}"))
    held = table.select("y", *names, *tests)
    wide = stored(VectorAssembler(inputCols=[*names, *[f"r{k}" for k in range(len(rules))]], outputCol="x").transform(held).select("y", "x"))
    lasso = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=LASSO, maxIter=100).fit(wide)
    w = [float(v) for v in lasso.coefficients.toArray()]
    return RuleModel(
        float(lasso.intercept), {n: v for n, v in zip(names, w) if v},
        {r: v for r, v in zip(rules, w[len(names):]) if v})


def scored(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id and score (0 to 1) of every row of `docs` (doc_id, text).

    Null and empty texts have all statistics zero and are scored like any other. Repeated rows
    score alike. An empty table gives an empty result. Other columns are ignored.
    """
    model = fitted(docs, labels, rows)
    return _measured(docs, [F.col("doc_id")]).select("doc_id", model.score().alias("score"))


def passing(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, keep: float = KEEP) -> DataFrame:
    """The rows of `docs` with a score of `keep` or more, with the columns of `docs`."""
    model = fitted(docs, labels, rows)
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    good = _measured(docs, [whole]).where(model.score() >= keep)
    return good.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
