"""Language identification in two levels: the family, then the languages within it.

Whole texts become hashed counts of byte one-, two- and three-grams, scaled to length one. Linear
support vector machines, one for each pair of families, vote for the family; then one for each
pair of its languages votes for the language. Languages of one family share letters and word
forms, so machines that only separate such a pair put their weight on what tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.llm.common import held_out, pieces, utf8
from duescope.storage import stored

SIZE = 1 << 11  # hashed counts
FIT_ROWS = 6_000  # rows with a language that the machines are fitted on, about; the only bound
ALIKE = 0.8  # least cosine between the mean texts of languages that a learned family holds
UNKNOWN = "und"
# Language families by ISO 639-1 code; languages not listed join the family whose texts are most like theirs
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi".split(),
    "romance": "fr es it pt ro ca gl oc rm".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "finno-ugric": "fi et hu".split(),
    "baltic": "lt lv".split(),
    "celtic": "ga cy gd br".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indo-aryan": "hi bn mr gu pa ur ne si".split(),
    "semitic": "ar he am mt".split(),
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def families_of(means: dict[str, np.ndarray]) -> dict[str, str]:
    """The family of each language, from the mean of its texts.

    Listed languages have the family of the table. The others, by name, join the family with the
    language most like them, if the cosine is at least ALIKE; else they found one of their own name.
    """
    out = {k: FAMILY[k] for k in means if k in FAMILY}
    unit = {k: m / (np.linalg.norm(m) or 1.0) for k, m in means.items()}
    for lang in sorted(set(means) - set(out)):
        near = max(((float(unit[lang] @ unit[k]), k) for k in out), default=(0.0, ""))
        out[lang] = out[near[1]] if near[0] >= ALIKE else f"like {lang}"
    return out


def counts(text: bytes) -> np.ndarray:
    """Hashed counts of grams, square roots taken, scaled to length one."""
    b = np.frombuffer(text.translate(_LOWER), np.uint8).astype(np.uint32)
    total = np.zeros(SIZE)
    for at in range(0, len(b), 1 << 20):
        c = b[at:at + (1 << 20) + 2]
        grams = [c[:1 << 20], (c[:-1] * 257 + c[1:] + 7919)[:1 << 20]]
        if len(c) > 2:
            grams.append((c[:-2] * 66049 + c[1:-1] * 257 + c[2:] + 104729)[:1 << 20])
        for g in grams:
            total += np.bincount(((g * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64), minlength=SIZE)
    root = np.sqrt(total)
    norm = np.sqrt((root * root).sum())
    return root / norm if norm else root


def has_letter(text: bytes) -> bool:
    low = text.translate(_LOWER)
    if low.translate(None, bytes(range(97, 123))) != low:
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


@dataclass
class Machines:
    """Pairs of names with the weights of their machine; positive decides for the first."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)

    def vote(self, x: np.ndarray) -> tuple[str, float]:
        """The name with the most wins, ties by the sum of margins; and how sure its closest win is."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = np.stack(self.weights) @ np.append(x, 1.0)
        wins, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        for (i, j), m in zip(self.pairs, margins):
            wins[i if m > 0 else j] += 1
            sums[i] += m
            sums[j] -= m
        best = max(range(len(wins)), key=lambda k: (wins[k], sums[k]))
        own = [m if i == best else -m for (i, j), m in zip(self.pairs, margins) if best in (i, j)]
        return self.names[best], float(1 / (1 + np.exp(-2 * min(own))))


@dataclass
class Model:
    families: Machines
    within: dict[str, Machines]

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not text or not has_letter(text) or not self.families.names:
            return UNKNOWN, 0.0
        x = counts(text)
        name, a = self.families.vote(x)
        lang, b = self.within[name].vote(x)
        return lang, a * b


def _machines(rows: DataFrame, label: str, names: list[str]) -> Machines:
    out = Machines(names)
    for i, j in combinations(range(len(names)), 2):
        pair = rows.where(F.col(label).isin(names[i], names[j])).select(
            "x", (F.col(label) == names[i]).cast("double").alias("y"))
        m = LinearSVC(featuresCol="x", labelCol="y", regParam=1e-4, maxIter=40, standardization=False).fit(pair)
        out.pairs.append((i, j))
        out.weights.append(np.append(m.coefficients.toArray(), m.intercept))
    return out


def fitted(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from text and lang of about `rows` rows that aren't held out. Null or empty texts
    and null languages are left out."""
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # rare languages are taken whole, frequent ones down to their share of the bound
    each = rows / max(1, len(sizes))
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, each / n))]) if sizes else F.create_map()
    taken = usable.where(F.length("text") > 0)
    if sizes:
        taken = taken.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            x = [counts(t) for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["lang", "x"])

    made = taken.select("lang", "text").mapInArrow(run, "lang string, x array<double>")
    table = stored(made.select("lang", array_to_vector("x").alias("x")))
    means = {r.lang: r.mean.toArray() for r in table.groupBy("lang").agg(Summarizer.mean(F.col("x")).alias("mean")).collect()}
    family = families_of(means)
    families = sorted(set(family.values()))
    of = F.create_map(*[F.lit(v) for kv in family.items() for v in kv]) if family else F.create_map()
    table = table.withColumn("family", of[F.col("lang")] if family else F.lit(""))
    return Model(_machines(table, "family", families),
                 {f: _machines(table, "lang", sorted(k for k in means if family[k] == f)) for f in families})


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row of `docs` (doc_id, text).

    Null texts and texts without a letter are `und` with score 0, and so is everything if the
    model has seen no language. Repeated rows are predicted alike. An empty table gives an empty
    result. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = [model.predict(t) for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
