"""Table sinks. The table format is a parameter; parquet is what plain Spark ships with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IDENTIFIERS = ("customer_id", "country", "cluster", "snapshot_date")


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet", enabled: bool = True) -> bool:
    """Replace data and schema of a managed table; returns whether it was written."""
    if not enabled:
        return False
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    return True


def overwrite_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions present in `df`, so that a re-run never duplicates rows.

    Rows are spread over `by` plus a hash of the row before writing, so one large
    partition value is written by several tasks.
    """
    width = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(width)))
    (
        spread.write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).save(path)
    )


def append_or_create(df: DataFrame, path: str, first: bool, fmt: str = "parquet") -> None:
    """First batch of a run overwrites, the following ones append."""
    df.write.format(fmt).mode("overwrite" if first else "append").save(path)


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    schema = table.rpartition(".")[0]
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")


def publish(df: DataFrame, staging: str, production: str, promote: bool = False,
            fmt: str = "parquet") -> list[str]:
    """Always write staging; production is replaced from the staged table on opt-in."""
    overwrite_table(df, staging, fmt)
    if not promote:
        return [staging]
    overwrite_table(df.sparkSession.table(staging), production, fmt)
    return [staging, production]


def stamped(df: DataFrame, as_of: dt.date | Column, country: str | None = None) -> DataFrame:
    out = df.withColumn("refresh_date", as_of if isinstance(as_of, Column) else F.lit(as_of))
    return out if country is None else out.withColumn("country", F.lit(country))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
