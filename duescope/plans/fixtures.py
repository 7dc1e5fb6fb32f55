"""Receivables tables derived from the star-schema test tables.

Orders are invoices, line items are invoice lines, customers keep their identity. Every
column is integer or date arithmetic on the given tables, so a SQL engine can derive the
same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duescope.config import CORRECTED, PanelConfig
from duescope.operators import grain
from duescope.sources import events, view

ANCHOR = dt.date(2001, 8, 1)
CFG: PanelConfig = CORRECTED(ANCHOR)


# Column types of the given tables; stated so that no job reads footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}.parquet")


def _invoice(key: str) -> Column:
    return F.col(key).cast("string").alias("invoice_id")


def _orders(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").select(
        "*", _invoice("o_orderkey"), F.col("o_orderdate").cast("date").alias("base"), _padded("o_custkey").alias("customer_id"))


def _lines(spark: SparkSession, path: str, orders: DataFrame | None = None) -> DataFrame:
    """Order lines with the columns of their order, dealt by invoice.

    The lines are dealt out as they are read, before the join and before dates and texts are made of
    them, so those of a single-block file spread over the cores. A join of two large sides and the
    roll-up to invoices find their rows together without moving them again.
    """
    lines = table(spark, path, "lineitem").select("*", _invoice("l_orderkey")).repartition("invoice_id")
    return lines.withColumn("ship", F.col("l_shipdate").cast("date")).join(
        _orders(spark, path) if orders is None else orders, "invoice_id")


def _padded(key: str, width: int = 10) -> Column:
    return F.lpad(F.col(key).cast("string"), width, "0")


def _compact(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit("-"), F.lit(""))


def _letter(n: Column) -> Column:
    return F.char((F.lit(65) + n).cast("int"))


def _heads(spark: SparkSession, path: str) -> DataFrame:
    """What all lines of an invoice share. Customers and places are looked up here, once an order:
    past broadcasting, that moves orders and leaves the lines where their invoice is."""
    customer, nation, region = (table(spark, path, t) for t in ("customer", "nation", "region"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    order, cust, nk = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    priority = F.col("o_orderpriority")
    rows = (
        _orders(spark, path)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({
            "cd1": F.when(priority == "4-NOT SPECIFIED", 7).otherwise(0),
            "cd2": F.when(priority == "3-MEDIUM", 14).otherwise(0),
            "net": F.when(priority.isin("1-URGENT", "2-HIGH"), 30).otherwise(0),
            "disputes": (order % 3).cast("int"),
            "base_text": F.col("base").cast("string"),
        })
        .withColumn("due", F.date_add("base", F.col("cd1") + F.col("cd2") + F.col("net")))
    )
    return rows.select(
        "invoice_id", "o_orderkey", "o_custkey", "o_orderstatus", "base", "base_text", "customer_id",
        "cd1", "cd2", "net", "disputes", "due", "n_name", "r_name", "c_mktsegment",
        F.concat(_letter(F.floor(nk / 5)), _letter(nk % 5), F.lit("01")).alias("company_code"),
        F.when(order % 97 == 0, "00000000").otherwise(_compact(F.col("base_text"))).alias("baseline"),
        F.when(order % 2 == 0, F.date_add("due", 2).cast("string")).alias("due_text"),
        (F.lit(200) + cust % 3000).cast("int").alias("tenure"),
        _letter(cust % 6).alias("risk_class"),
        (F.greatest("c_acctbal", F.lit(0.0)) * 10).alias("credit_limit"),
    )


def raw_view(spark: SparkSession, path: str) -> DataFrame:
    """The unified view with text dates in mixed forms, as a source system delivers it."""
    rows = _lines(spark, path, _heads(spark, path))
    status, line, order, cust = (
        F.col(c) for c in ("o_orderstatus", "l_linenumber", "o_orderkey", "o_custkey")
    )
    settled = (
        (status == "F") | ((status == "P") & (line % 2 == 0))
        | (F.col("base") < F.lit(dt.date(2001, 4, 3)))
    )
    clearing = F.when(
        settled, F.date_add("base", (F.lit(3) + (order * 7 + cust) % 140).cast("int"))
    )
    rows = rows.withColumns({
        "clear": clearing,
        "dunned": F.col("l_returnflag") == "R",
        "promised": F.col("l_returnflag") == "A",
    })
    amount = F.col("l_extendedprice")
    return rows.select(
        "customer_id", "invoice_id",
        line.cast("string").alias("line_item"),
        "company_code",
        amount.alias("invoice_amount"),
        F.when(F.col("clear").isNull(), amount).otherwise(0.0).alias("open_amount"),
        F.col("baseline").alias("baseline_date"),
        F.col("base_text").alias("document_entry_date"),
        _compact(F.col("clear")).alias("clearing_date"),
        F.col("cd1").alias("cash_discount_days_1"),
        F.col("cd2").alias("cash_discount_days_2"),
        F.col("net").alias("net_payment_days"),
        F.col("due_text").alias("due_date"),
        F.datediff(F.coalesce("clear", F.lit(ANCHOR)), F.col("due")).alias("days_past_due"),
        status.alias("invoice_status"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("tenure").alias("customer_tenure_days"),
        F.when(F.col("dunned"), 1 + line % 4).alias("dunning_level"),
        F.when(F.col("dunned"), F.col("ship").cast("string")).alias("last_dunned_date"),
        F.when(F.col("dunned"), (1 + order % 3).cast("int")).alias("dunning_count"),
        F.when(F.col("promised"), F.floor(amount) * 0.5).alias("fin_promised_amt"),
        F.when(F.col("promised"), line % 4).alias("fin_p2p_state"),
        F.when(F.col("promised"), _compact(F.col("ship"))).alias("promise_dt"),
        "risk_class",
        F.col("c_mktsegment").alias("credit_group"),
        "credit_limit",
        F.when(F.col("disputes") > 0, F.col("base_text")).alias("dispute_create_date"),
        F.col("disputes").alias("number_of_disputes"),
        F.when(F.col("disputes") > 0, amount * 0.1).otherwise(0.0).alias("open_dispute_amount"),
        F.col("l_linestatus").alias("payment_method"),
        F.when(F.col("clear").isNull(), "bsid").otherwise("BSAD").alias("source"),
    )


def _raw_items(spark: SparkSession, path: str, still_open: bool) -> DataFrame:
    rows = raw_view(spark, path).filter(
        F.col("clearing_date").isNull() if still_open else F.col("clearing_date").isNotNull()
    )
    return rows.select(
        F.col("customer_id").alias("KUNNR"), F.col("invoice_id").alias("BELNR"),
        F.col("line_item").alias("BUZEI"), F.col("company_code").alias("BUKRS"),
        F.col("invoice_amount").alias("WRBTR"), F.col("baseline_date").alias("ZFBDT"),
        F.col("clearing_date").alias("AUGDT"),
        F.col("cash_discount_days_1").alias("ZBD1T"),
        F.col("cash_discount_days_2").alias("ZBD2T"), F.col("net_payment_days").alias("ZBD3T"),
    )


def raw_open(spark: SparkSession, path: str) -> DataFrame:
    return _raw_items(spark, path, still_open=True)


def raw_cleared(spark: SparkSession, path: str) -> DataFrame:
    return _raw_items(spark, path, still_open=False)


def raw_letters(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).filter(F.col("l_returnflag") == "R").select(
        F.col("customer_id").alias("KUNNR"), F.col("invoice_id").alias("BELNR"),
        _compact(F.col("ship")).alias("LAUFD"),
        (1 + F.col("l_linenumber") % 4).cast("string").alias("MAHNN"),
    )


def raw_promises(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).filter(F.col("l_returnflag") == "A").select(
        F.col("customer_id").alias("FIN_CUSTOMER"),
        F.concat(F.lit("0000"), _padded("o_orderkey")).alias("FIN_INVOICE_KEY"),
        (F.floor("l_extendedprice") * 0.5).alias("FIN_PROMISED_AMT"),
        (F.col("l_linenumber") % 4).cast("string").alias("FIN_P2P_STATE"),
        _compact(F.col("ship")).alias("FIN_P2P_DATE"),
    )


def raw_master(spark: SparkSession, path: str) -> DataFrame:
    customer, nation, region = (table(spark, path, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _padded("c_custkey").alias("KUNNR"), F.col("n_name").alias("LAND1"),
            F.col("r_name").alias("REGIO"),
        )
    )


def letters(spark: SparkSession, path: str) -> DataFrame:
    return events.dunning_letters(raw_letters(spark, path))


def promises(spark: SparkSession, path: str) -> DataFrame:
    return events.promises(raw_promises(spark, path))


def items(spark: SparkSession, path: str, cfg: PanelConfig = CFG, mode: str = "train") -> DataFrame:
    """Typed lines with country and recomputed due date."""
    return grain.recomputed_due_date(view.mode_items(raw_view(spark, path), cfg, mode))


def invoices(spark: SparkSession, path: str, cfg: PanelConfig = CFG,
             mode: str = "train") -> DataFrame:
    return grain.invoices(items(spark, path, cfg, mode))
