"""Intermediate tables on storage every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Where it is unset, a session that runs inside this one process (local mode, as in tests)
    gets a folder of its own that goes with the process; on a cluster it is an error, since
    every executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="duescope-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def run_folder(spark: SparkSession) -> str:
    """One folder per application, so that a run's tables can be dropped together."""
    return f"{shared_folder(spark).rstrip('/')}/duescope-{spark.conf.get('spark.app.id')}"


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{run_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what `stored` and `new_path` of this application have written. Results that are
    still to be read from it are gone afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once and read it back.

    For tables that several branches of a plan read: it is computed once, its lineage is
    cut, and losing an executor costs a re-read instead of a recomputation.
    """
    path = new_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
