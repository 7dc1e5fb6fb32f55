"""Labelled rows for a fit: bounded, outside the held-out fold, the same at every size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.llm.common import held_out
from duescope.storage import stored

FIT_ROWS = 20_000  # labelled documents that a model is fitted on, about; the only bound


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """(text, y) of about `rows` labelled documents that aren't held out, stored.

    A document is taken if a hash of its id falls under rows / labelled. Null labels, ids and
    texts, and ids with differing labels are left out. The ids go to a small table first, whose
    size lets Spark broadcast it instead of moving texts.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    one = usable.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("other")).where("y = other")
    ids = stored(one.select("doc_id", "y"))
    share = F.lit(float(rows)) / F.greatest(F.lit(1), F.lit(ids.count()))
    taken = stored(ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return stored(texts.join(taken, "doc_id").select("text", F.col("y").cast("double").alias("y")))
