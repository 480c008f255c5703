"""Bronze -> silver: typing, cleaning, pseudonymisation.

All operators are narrow projections/filters: no shuffle, fully codegen'd,
and Catalyst pushes the filters and column pruning into the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from partnerwatch.functions.scalar import (
    days_between,
    lenient_double,
    lenient_int,
    money,
    parse_epoch_date,
    pseudonym,
)
from partnerwatch.schemas import SILVER_STRING_COLUMNS


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def silver_projection(bronze: DataFrame) -> DataFrame:
    """Typed silver rows (P1-P5): text keys, absolute amount, lenient numbers,
    parsed due date; rows without a finite amount or without partner are dropped
    (and counted by ``silver_reject_count``)."""
    strings = [F.col(c).cast("string").alias(c) for c in SILVER_STRING_COLUMNS]
    typed = [
        F.abs(money("AmountInDisplayCurrency")).alias("Amount"),
        lenient_double("BalanceAmountInDisplayCurrency").alias("Balance"),
        lenient_double("DebitAmountInDisplayCrcy").alias("TotalDebit"),
        lenient_double("CreditAmountInDisplayCrcy").alias("TotalCredit"),
        lenient_int("NumberOfItems").alias("NumberOfItems"),
        parse_epoch_date("CANetDueDate").alias("NetDueDate"),
    ]
    return bronze.select(*strings, *typed).dropna(subset=["Amount", "BusinessPartner"])


def build_silver(bronze: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Bronze -> silver. With ``observation`` the raw and kept row counts ride
    along the single scan (no second pass for the log line, S9)."""
    if observation is None:
        return silver_projection(bronze)
    counted = bronze.observe(observation, F.count(F.lit(1)).alias("raw_rows"))
    return silver_projection(counted)


def add_days_overdue(df: DataFrame, as_of: date, due_col: str = "NetDueDate",
                     clip_negative: bool = False, out_col: str = "DaysOverdue") -> DataFrame:
    """Signed (pipeline) or clipped-at-zero (notebook) days past due."""
    return df.withColumn(out_col, days_between(as_of, due_col, clip_negative))


def pseudonymise(df: DataFrame, name_col: str = "BusinessPartnerName",
                 redact_cols: Sequence[str] = ("FirstName", "LastName", "PostalCode")) -> DataFrame:
    """P8 + P9: hash the partner name to ``CUSTOMER_XXXXXX`` and blank personal columns."""
    out = {name_col: pseudonym(name_col)} if name_col in df.columns else {}
    out.update({c: F.lit("REDACTED") for c in redact_cols})
    return df.withColumns(out)


def silver_reject_count(bronze: DataFrame) -> DataFrame:
    """One-row count of bronze lines the silver filter rejects (Q3)."""
    amount = money("AmountInDisplayCurrency")
    bad = amount.isNull() | F.col("BusinessPartner").isNull()
    return bronze.agg(F.count_if(bad).alias("rejected_rows"), F.count(F.lit(1)).alias("raw_rows"))


# ------------------------------------------------------------------ S2, S9: rejected lines
def reject_causes() -> Column:
    """Why a bronze line is no silver row: causes by column, empty for kept lines."""
    text = F.trim("AmountInDisplayCurrency")
    number = lenient_double("AmountInDisplayCurrency")
    amount = (F.when(text.isNull() | (text == ""), "missing").when(number.isNull(), "not a number")
              .when(F.isnan(number) | (F.abs(number) == float("inf")), "not finite").when(F.abs(number) >= 1e26, "too large"))
    causes = [F.concat(F.lit("AmountInDisplayCurrency: "), amount),
              F.when(F.col("BusinessPartner").isNull(), "BusinessPartner: missing")]
    return F.array_compact(F.array(*causes))


def judged_lines(bronze: DataFrame) -> DataFrame:
    """Every bronze line, typed, with ``accepted``, ``causes``, its raw fields as one
    JSON text where it is rejected, and where it stands: file, start of the split that
    read it (0 for whole files) and number within that split, from 0.

    One projection over one scan: written partitioned by ``accepted`` it fills both
    sinks in one job (``sources.files.write_judged``)."""
    strings = [F.col(c).cast("string").alias(c) for c in SILVER_STRING_COLUMNS]
    typed = [
        F.abs(money("AmountInDisplayCurrency")).alias("Amount"),
        lenient_double("BalanceAmountInDisplayCurrency").alias("Balance"),
        lenient_double("DebitAmountInDisplayCrcy").alias("TotalDebit"),
        lenient_double("CreditAmountInDisplayCrcy").alias("TotalCredit"),
        lenient_int("NumberOfItems").alias("NumberOfItems"),
        parse_epoch_date("CANetDueDate").alias("NetDueDate"),
    ]
    raw = [c for c in bronze.columns if c not in ("_file", "_split", "_number")]
    causes = reject_causes()
    place = [F.col(c) if c in bronze.columns else F.lit(None).cast(t).alias(c)
             for c, t in (("_file", "string"), ("_split", "bigint"), ("_number", "bigint"))]
    return bronze.select(*strings, *typed, (F.size(causes) == 0).alias("accepted"), causes.alias("causes"),
                         F.when(F.size(causes) > 0, F.to_json(F.struct(*raw))).alias("raw"), *place)
