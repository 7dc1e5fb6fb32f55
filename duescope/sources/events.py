"""Dunning letters, payment promises and the customer master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.functions import dates as D


def dunning_letters(mhnd: DataFrame) -> DataFrame:
    return mhnd.select(
        F.col("KUNNR").alias("customer_id"),
        F.col("BELNR").alias("invoice_id"),
        D.compact_date(F.col("LAUFD")).alias("dunning_date"),
        F.col("MAHNN").try_cast("int").alias("dunning_level"),
    )


def promises(p2p: DataFrame) -> DataFrame:
    """The invoice number is characters 5 to 14 of the composite key."""
    return p2p.select(
        F.col("FIN_CUSTOMER").alias("customer_id"),
        F.substring("FIN_INVOICE_KEY", 5, 10).alias("invoice_id"),
        F.col("FIN_PROMISED_AMT").cast("double").alias("promised_amount"),
        F.col("FIN_P2P_STATE").try_cast("int").alias("promise_state"),
        D.compact_date(F.col("FIN_P2P_DATE")).alias("promise_date"),
    )


def customer_master(kna1: DataFrame) -> DataFrame:
    return kna1.select(
        F.col("KUNNR").alias("customer_id"),
        F.col("LAND1").alias("country"),
        F.col("REGIO").alias("region"),
    )
