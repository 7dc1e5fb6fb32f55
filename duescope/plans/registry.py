"""Named queries: a Spark plan and, where SQL can say the same, its oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duescope.plans import sqlviews


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
COMPILED = 8000  # bytes of generated code above which HotSpot interprets a method
TASK_INPUT = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def tuned(spark: SparkSession) -> SparkSession:
    """Stages that outgrow what the JVM compiles, as the wide scans do, run operator by operator instead.
    Shuffles are merged to tasks of 16 MB where the session names no size: histories unpack to some
    thirty times that, which at Spark's 64 MB is gigabytes a task."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED)
    spark.conf.set(TASK_INPUT, spark.conf.get(TASK_INPUT, "16m"))
    return spark


def _parse(spec: str) -> dict[str, str]:
    return dict(part.rsplit(":", 1) for part in spec.split())


def presented(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Doubles and nullable counts rounded to the digits of the spec, dates as ISO text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = spec.get(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif kind not in (None, "d") and isinstance(f.dataType, T.IntegralType):
            c = c.cast("double")  # nothing to round
        elif kind not in (None, "d"):
            c = F.round(c.cast("double"), int(kind)) + F.lit(0.0)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def presented_sql(sql: str, spec: dict[str, str]) -> str:
    parts = [
        f'CAST("{name}" AS VARCHAR) AS "{name}"' if kind == "d"
        else f'round(CAST("{name}" AS DOUBLE), {kind}) + 0.0 AS "{name}"'
        for name, kind in spec.items()
    ]
    if not parts:
        return f"SELECT * FROM (\n{sql}\n) AS presented"
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) AS presented"


def query(name: str, spec: str = "", uses: str = "", sql: str | None = None):
    """Register a plan. `spec` lists "column:digits" for doubles and "column:d" for dates;
    `uses` names the shared SQL views the oracle text reads."""
    wanted = _parse(spec)

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        text = None
        if sql is not None:
            text = sqlviews.with_views(uses.split(), presented_sql(sql.strip(), wanted))
        QUERIES[name] = Query(lambda spark, path: presented(fn(tuned(spark), path), wanted), text)
        return fn

    return register
