"""Declared schemas: bronze (all text), silver (typed), alert history."""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE_TEXT_COLUMNS: tuple[str, ...] = (
    "BusinessPartner", "BusinessPartnerName", "FirstName", "LastName", "PostalCode", "CompanyCode",
    "ContractAccount", "CADocumentNumber", "CADocumentType", "CAMainTransaction",
    "CASubTransaction", "CAAccountDeterminationCode", "AmountInDisplayCurrency",
    "BalanceAmountInDisplayCurrency", "DebitAmountInDisplayCrcy", "CreditAmountInDisplayCrcy",
    "NumberOfItems", "CANetDueDate",
)

BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in BRONZE_TEXT_COLUMNS])

SILVER_STRING_COLUMNS: tuple[str, ...] = (
    "BusinessPartner", "BusinessPartnerName", "FirstName", "LastName", "PostalCode", "CompanyCode",
    "ContractAccount", "CADocumentNumber", "CADocumentType", "CAMainTransaction",
    "CASubTransaction", "CAAccountDeterminationCode",
)

SILVER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in SILVER_STRING_COLUMNS]
    + [
        T.StructField("Amount", T.DoubleType(), True),
        T.StructField("Balance", T.DoubleType(), True),
        T.StructField("TotalDebit", T.DoubleType(), True),
        T.StructField("TotalCredit", T.DoubleType(), True),
        T.StructField("NumberOfItems", T.IntegerType(), True),
        T.StructField("NetDueDate", T.TimestampType(), True),
    ]
)

HISTORY_SCHEMA = T.StructType([
    T.StructField("BusinessPartner", T.StringType(), True),
    T.StructField("Segment", T.StringType(), True),
    T.StructField("PeerGroup", T.StringType(), True),
    T.StructField("risk_score", T.DoubleType(), True),
    T.StructField("isolation_forest_flag", T.BooleanType(), True),
    T.StructField("iqr_flag", T.BooleanType(), True),
    T.StructField("flag_reason", T.StringType(), True),
    T.StructField("TotalAmount", T.DoubleType(), True),
    T.StructField("ReversalRatio", T.DoubleType(), True),
    T.StructField("MaxSingleAmount", T.DoubleType(), True),
    T.StructField("run_date", T.DateType(), True),
])
