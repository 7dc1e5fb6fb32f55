"""Inputs of the view: joins by order, dates in any form, files of stored views."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from duescope.config import CORRECTED
from duescope.functions import dates
from duescope.plans import fixtures as fx
from duescope.plans.registry import presented
from duescope.sources import view

DAY = dt.datetime(2001, 3, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables").as_posix()
    rows = {
        "region": [(0, "EUROPE")],
        "nation": [(3, "NATION_3", 0), (7, "NATION_7", 0)],
        # a customer twice, one without a nation and one that no order names
        "customer": [(1, "a", 3, 10.0, "X"), (1, "a", 7, -5.0, "Y"), (2, "b", None, 1.0, "X"), (3, "c", 3, None, None), (4, "d", 3, 1.0, "X")],
        "orders": [(10, 1, "F", 1.0, DAY, "1-URGENT"), (97, 3, "O", 1.0, DAY, "3-MEDIUM"), (11, 2, "F", 1.0, DAY, None),
                   (12, None, "F", 1.0, DAY, None), (None, 1, "F", 1.0, DAY, None), (13, 3, None, 1.0, None, "4-NOT SPECIFIED")],
        "lineitem": [(k, 1, 1, n, 1.0, 100.0 + n, 0.0, 0.0, flag, "O", DAY)
                     for k in (10, 97, 11, 12, None, 13, 99) for n, flag in ((1, "R"), (2, "A"), (2, "A"))],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, fx.SCHEMAS[name]).write.parquet(f"{path}/{name}.parquet")
    return path


def test_lines_meet_customers_by_order_only(spark, tables, capsys):
    """Past broadcasting, lines are joined once, by invoice, and stay where that put them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fx.raw_view(spark, tables).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in capsys.readouterr().out.splitlines() if "Join" in line]
    assert len(joins) == 4
    assert "invoice_id" in joins[0] and not any("invoice_id" in j for j in joins[1:])


def test_raw_view_rows(spark, tables):
    got = sorted(fx.raw_view(spark, tables).select(
        "invoice_id", "line_item", "country", "company_code", "baseline_date", "due_date", "net_payment_days", "credit_limit").collect(), key=str)
    lines = ("1", "2", "2")
    expected = [
        *[("10", n, c, code, "20010301", "2001-04-02", 30, limit) for n in lines
          for c, code, limit in (("NATION_3", "AD01", 100.0), ("NATION_7", "BC01", 0.0))],
        *[("97", n, "NATION_3", "AD01", "00000000", None, 0, 0.0) for n in lines],
        *[("13", n, "NATION_3", "AD01", None, None, 0, 0.0) for n in lines],
    ]
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted((spark.createDataFrame(
        expected, "invoice_id string, line_item string, country string, company_code string, baseline_date string, "
        "due_date string, net_payment_days int, credit_limit double").collect()), key=str)]


def test_any_date_forms(spark):
    day, forms = "2001-03-01", {}
    forms |= dict.fromkeys(("20010301", " 20010301 ", "2001-03-01", "2001-3-1", "2001-03-01 10:00"), day)
    forms |= dict.fromkeys(("00000000", "", "  ", "2001030T", "20-10301", "20010229", "2001-02-29", "2001030", None))
    forms |= {"200103-1": "+200103-01-01", "-2010301": "-2010301-01-01"}  # years, as Spark reads text with a dash
    df = spark.createDataFrame([(k,) for k in forms], "d string")
    got = {r[0]: r[1] for r in df.select("d", dates.any_date(F.col("d")).cast("string")).collect()}
    assert got == forms
    compact = {r[0]: r[1] for r in df.select("d", dates.compact_date(F.col("d")).cast("string")).collect()}
    assert compact == {k: None if k is None or "-" in k else v for k, v in forms.items()}


def test_whole_numbers_are_shown_as_doubles(spark):
    df = spark.createDataFrame([(2**53 + 1, -3, -0.004), (None, None, None)], "a long, b int, c double")
    rows = presented(df, {"a": "2", "b": "0", "c": "2"}).collect()
    assert [tuple(r) for r in rows] == [(float(2**53), -3.0, 0.0), (None, None, None)]
    assert str(rows[0].c) == "0.0"


def test_a_small_month_is_one_file(spark, tables, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored_months(spark, tables, tmp_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def stored_months(spark, tables, tmp_path):
    cfg = CORRECTED(dt.date(2001, 8, 1))
    raw = fx.raw_view(spark, tables).crossJoin(spark.range(50).withColumnRenamed("id", "copy")).withColumn(
        "invoice_id", F.concat("invoice_id", F.col("copy").cast("string"))).drop("copy")
    for name, store in (("clean", view.store_clean), ("settled", view.store_settled)):
        target = (tmp_path / name).as_posix()
        store(raw, cfg, target)
        for folder, _, files in os.walk(target):
            assert sum(f.endswith(".parquet") for f in files) <= 1, folder
    assert view.clean_items(spark, (tmp_path / "clean").as_posix(), cfg, "serve").count() == 6 * 50
