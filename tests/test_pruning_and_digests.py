"""Scans that read only the folders they need, and reconciliation by digests."""

import random
import re

from pyspark.sql import functions as F

from duescope.operators import recon
from duescope.plans import fixtures as fx
from duescope.sources import view

DATA = "/root/testdata/sf0.001"


def plan_of(spark, df):
    return df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_source_aware_scan_prunes_settled_months(spark, tmp_path):
    target = f"file://{tmp_path}/settled"
    view.store_settled(fx.raw_view(spark, DATA), fx.CFG, target)
    found = view.settled_items(spark, target, fx.CFG)
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan_of(spark, found))
    assert filters and "settled" in filters[1]
    read = {f.rsplit("settled=", 1)[1].split("/")[0] for f in found.inputFiles()}
    floor = (fx.CFG.anchor.replace(year=fx.CFG.anchor.year - 2)).strftime("%Y-%m")
    months = {r.settled for r in spark.read.parquet(target).select("settled").distinct().collect()}
    assert "open" in months and min(months) < floor
    whole = view.source_aware_items(fx.raw_view(spark, DATA), fx.CFG)
    assert sorted(found.columns) == sorted(whole.columns)
    assert found.select(*whole.columns).exceptAll(whole).count() == 0 and whole.exceptAll(found.select(*whole.columns)).count() == 0
    one = view.settled_items(spark, target, fx.CFG, ["aa"])
    assert {r.country for r in one.select("country").distinct().collect()} <= {"AA"}
    assert read  # files are known without a scan of the data


def table(spark, rows):
    return spark.createDataFrame(rows, "k long, day string, x double, n int, name string")


def test_changed_rows_are_found_bucket_by_bucket(spark):
    rng = random.Random(8)
    rows = [(i, "d", rng.random(), None if i % 9 == 0 else i, None if i % 7 == 0 else "a") for i in range(400)]
    other = [list(r) for r in rows]
    other[3][2] += 0.5
    other[9][3] = 1          # null to a value
    other[14][4] = ""        # null to empty text
    del other[50]
    other.append([900, "d", 1.0, 1, "b"])
    old, new = table(spark, rows), table(spark, [tuple(r) for r in other])
    for buckets in (1, 16, recon.BUCKETS):
        found = recon.changed_rows(old, new, ["k", "day"], ["x", "n", "name"], buckets)
        got = {r.k: (r.change, None if r.x_delta is None else round(r.x_delta, 6)) for r in found.collect()}
        assert got == {3: ("changed", -0.5), 9: ("changed", 0.0), 14: ("changed", 0.0), 50: ("old", None), 900: ("new", None)}
    assert recon.differing_buckets(old, new, ["k"], ["x", "n", "name"], recon.BUCKETS).count() <= 5


def test_equal_tables_join_nothing(spark):
    rows = [(i, "d", i / 3, i, "a") for i in range(200)]
    old, new = table(spark, rows), table(spark, rows[::-1]).repartition(7)
    assert recon.differing_buckets(old, new, ["k"], ["x", "n", "name"]).count() == 0
    assert recon.changed_rows(old, new, ["k"], ["x", "n", "name"]).count() == 0
    none = table(spark, [])
    assert recon.changed_rows(none, none, ["k"], ["x"]).count() == 0
    assert {r.change for r in recon.changed_rows(none, new, ["k"], ["x"]).select("change").distinct().collect()} == {"new"}


def test_numbered_sample_is_the_same_whatever_the_partitions(spark):
    rows = spark.range(5000).withColumn("k", F.col("id"))
    some = recon.numbered_sample(rows, F.col("k"), 10)
    again = recon.numbered_sample(rows.repartition(13), F.col("k"), 10)
    assert {r.id for r in some.collect()} == {r.id for r in again.collect()}
    assert 350 < some.count() < 650


def test_queries_keep_stages_within_what_the_jvm_compiles(spark):
    """The limit that makes wide scans leave one generated method; registered queries set it themselves."""
    from duescope.plans import load_all, registry

    load_all()
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    build = next(iter(registry.QUERIES.values())).build
    try:
        build(spark, "/nowhere")
    except Exception:
        pass
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == registry.COMPILED
