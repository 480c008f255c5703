"""Adapters from the driver's test tables to the ledger and alert-stream shapes.

``ledger_bronze`` yields the raw, all-text receivables lines the bronze layer
would hold (``lineitem`` joined to ``orders`` and ``customer``); ``alert_stream``
yields a multi-row alert table from ``events``. Both only project and join, so
their cost grows with the input tables and Catalyst prunes unused columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerwatch.functions.scalar import label_lookup

# Fixed values of the fixture mapping (test-data codes -> ledger codes).
RETURN_FLAG_TO_DOC_TYPE = {"A": "AC", "R": "ZC", "N": "RV"}
MARKET_SEGMENT_TO_CODE = {
    "AUTOMOBILE": "Z1", "BUILDING": "Z2", "FURNITURE": "Z3", "HOUSEHOLD": "Z4", "MACHINERY": "Z9",
}
ORDER_PRIORITY_TO_MAIN_TXN = {
    "1-URGENT": "R000", "2-HIGH": "0060", "3-MEDIUM": "MG00", "4-NOT SPECIFIED": "6000", "5-LOW": "ZZZZ",
}
LEDGER_AS_OF = date(2002, 1, 1)
ALERTS_AS_OF = date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c) -> F.Column:
    return c.cast("string")


def document_number() -> F.Column:
    """Fixed-width text key whose string order equals the order of
    (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice); unique.
    Every part has the 19 digits of the largest bigint, so none is ever cut."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    parts = [*(F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), cents]
    padded = F.concat_ws("-", *(F.lpad(_text(p), 19, "0") for p in parts))
    # the same text from slices of zeros, in half the time of lpad, which is left for
    # rows with a null part (skipped) or one of 20 characters (cut)
    fits = F.least(*(p.cast("bigint") for p in parts)) > F.lit(-10 ** 18)
    pieces = [x for p in parts for x in (F.lit("-"), F.substring(F.lit("0" * 19), F.lit(1), F.lit(19) - F.length(_text(p))), _text(p))]
    return F.coalesce(F.when(fits, F.concat(*pieces[1:])), padded)


def _ledger_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, F.Column]:
    """Order lines with their order and customer, and the signed amount. Customers are
    joined to orders first, so that the lines are shuffled once, by order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    placed = orders.join(cust, orders.o_custkey == cust.c_custkey)
    rows = li.join(placed, li.l_orderkey == placed.o_orderkey)
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity") * F.lit(12.5)
    return rows, F.when(flag == "N", F.col("l_extendedprice")).when(flag == "R", quantity).when(flag == "A", -quantity)


def _ledger_keys() -> list[F.Column]:
    """The text columns that bronze and silver share."""
    codes = F.create_map(*[F.lit(x) for kv in RETURN_FLAG_TO_DOC_TYPE.items() for x in kv])
    return [
        _text(F.col("o_custkey")).alias("BusinessPartner"),
        F.col("c_name").alias("BusinessPartnerName"),
        *(F.lit(None).cast("string").alias(c) for c in ("FirstName", "LastName", "PostalCode", "CompanyCode")),
        _text(F.col("l_suppkey")).alias("ContractAccount"),
        document_number().alias("CADocumentNumber"),
        codes[F.col("l_returnflag")].alias("CADocumentType"),
        label_lookup("o_orderpriority", ORDER_PRIORITY_TO_MAIN_TXN, "ZZZZ").alias("CAMainTransaction"),
        F.lit(None).cast("string").alias("CASubTransaction"),
        label_lookup("c_mktsegment", MARKET_SEGMENT_TO_CODE, "Z9").alias("CAAccountDeterminationCode"),
    ]


def ledger_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ledger lines, every column text, as landed from the source system."""
    rows, amount = _ledger_rows(spark, sf_dir)
    epoch_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    return rows.select(
        *_ledger_keys(),
        _text(amount).alias("AmountInDisplayCurrency"),
        _text(F.col("o_totalprice")).alias("BalanceAmountInDisplayCurrency"),
        _text(F.col("c_acctbal")).alias("DebitAmountInDisplayCrcy"),
        _text(F.col("l_extendedprice") * F.col("l_discount")).alias("CreditAmountInDisplayCrcy"),
        _text(F.col("l_quantity").cast("int")).alias("NumberOfItems"),
        F.concat(F.lit("/Date("), _text(epoch_ms), F.lit(")/")).alias("CANetDueDate"),
    )


def ledger_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed silver rows of ``ledger_bronze`` without the text round trip
    (what a silver Parquet read yields; values are identical, since the
    bronze text of every number parses back to the same double)."""
    rows, amount = _ledger_rows(spark, sf_dir)
    out = rows.select(
        *_ledger_keys(),
        F.abs(amount).alias("Amount"),
        F.col("o_totalprice").alias("Balance"),
        F.col("c_acctbal").alias("TotalDebit"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("TotalCredit"),
        F.col("l_quantity").cast("int").alias("NumberOfItems"),
        F.col("l_shipdate").cast("timestamp").alias("NetDueDate"),
    )
    return out.dropna(subset=["Amount", "BusinessPartner"])


def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-row alert table: one row per event, flags from the event type."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    et = F.col("event_type")
    return ev.select(
        _text(F.col("user_id")).alias("BusinessPartner"),
        F.col("event_id"),
        et.isin("error", "click").alias("isolation_forest_flag"),
        et.isin("error", "purchase").alias("iqr_flag"),
        (F.col("value") / F.lit(1000.0)).alias("risk_score"),
        F.col("ts").cast("date").alias("run_date"),
        et.alias("Segment"),
        F.concat(et, F.lit("_Events")).alias("PeerGroup"),
        F.col("value").alias("TotalAmount"),
        (F.col("value") / F.lit(100.0)).alias("ReversalRatio"),
        F.col("value").alias("MaxSingleAmount"),
    )


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History fixture: earlier ``error`` alerts with value above 150, stamped by day."""
    ev = alert_stream(spark, sf_dir)
    return ev.filter((F.col("Segment") == "error") & (F.col("TotalAmount") > 150)).select(
        "BusinessPartner", "Segment", "PeerGroup", "risk_score", "isolation_forest_flag", "iqr_flag",
        F.lit("history").alias("flag_reason"), "TotalAmount", "ReversalRatio", "MaxSingleAmount", "run_date",
    )
