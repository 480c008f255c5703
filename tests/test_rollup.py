"""Partner rollup (A1/A2), which the reference leaves untested."""

from __future__ import annotations

import numpy as np
import pytest

from partnerwatch.operators import features


SCHEMA = ("BusinessPartner string, BusinessPartnerName string, CADocumentNumber string, CADocumentType string, "
          "CAMainTransaction string, ContractAccount string, Amount double, NumberOfItems int, Balance double, "
          "TotalDebit double, TotalCredit double, DaysOverdue int, Segment string, TransactionType string")


@pytest.fixture
def tx(spark):
    rows = [
        ("A", None, "003", "AC", "R000", "c1", 100.0, 1, 5.0, 1.0, 0.5, 10, "Standard", "Receivable"),
        ("A", "Alpha", "002", "ZC", "R000", "c1", 100.0, 2, 7.0, 2.0, 0.1, 20, "Standard", "Payment"),
        ("A", "Alpha2", "004", "RV", "0060", "c2", 55.0, 3, 6.0, 3.0, 0.2, -5, "Standard", "Payment"),
        ("A", "Alpha3", "005", "AC", "0060", None, 30.0, 4, 1.0, 4.0, 0.3, 40, "Standard", "Receivable"),
        ("B", "Beta", "001", "AC", "R000", "c9", 10.0, 1, 1.0, 1.0, 1.0, 1, "Corporate", "Receivable"),
        ("B", "Beta", "006", "ZC", "R000", "c9", 10.0, 1, 1.0, 1.0, 1.0, 1, "Corporate", "Receivable"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    df = features.add_reversal_flags(df)
    df = features.add_value_flags(df)
    df = features.add_ros_score(df)
    df = features.add_round_flags(df)
    return features.net_cancellation_pairs(df)


def test_rollup_clean_rows_and_netted_count(tx):
    out = {r.BusinessPartner: r for r in features.aggregate_to_partner_level(tx).collect()}
    # B: every row netted -> partner dropped (Q8)
    assert set(out) == {"A"}
    a = out["A"]
    assert a.NettedPairsCount == 2 and a.TotalTransactions == 2
    assert a.TotalAmount == 85.0 and a.AvgAmount == 42.5
    assert a.StdAmount == pytest.approx(np.std([55.0, 30.0], ddof=1))
    assert a.MaxSingleAmount == 55.0 and a.TotalItems == 7
    assert (a.UniqueDocTypes, a.UniqueMainTransactions, a.UniqueContracts) == (2, 1, 1)
    assert (a.ACDocCount, a.ZCDocCount, a.ReversalRatio) == (1, 0, 0.0)
    assert a.AvgDaysOverdue == 17.5 and a.MaxDaysOverdue == 40
    assert a.Balance == 6.0 and a.TotalDebit == 4.0 and a.TotalCredit == 0.3
    assert a.AmountVolatility == pytest.approx(np.std([55.0, 30.0], ddof=1) / 43.5)
    assert a.RoundTransactionCount == 1 and a.RoundTransactionRate == pytest.approx(1 / 3)
    # first non-null values in document-number order among clean rows
    assert (a.BusinessPartnerName, a.Segment, a.TransactionType) == ("Alpha2", "Standard", "Payment")


def test_rollup_without_netting(tx):
    out = {r.BusinessPartner: r for r in features.aggregate_to_partner_level(tx, use_netted=False).collect()}
    assert out["B"].TotalTransactions == 2 and out["B"].NettedPairsCount == 0
    assert out["A"].BusinessPartnerName == "Alpha" and out["A"].TransactionType == "Payment"


def test_single_row_std_is_zero(spark):
    df = spark.createDataFrame([("A", "1", 5.0)], "BusinessPartner string, CADocumentNumber string, Amount double")
    r = features.aggregate_to_partner_level(df).collect()[0]
    assert r.StdAmount == 0.0 and r.AmountVolatility == 0.0


def test_slim_rollup_columns(tx):
    slim = features.partner_rollup_raw(tx)
    assert slim.columns == [c for c in features.SLIM_ROLLUP_COLUMNS if c in slim.columns]
    assert slim.count() == 2


def test_rollup_partition_invariant(tx):
    a = sorted(map(tuple, features.aggregate_to_partner_level(tx).collect()))
    b = sorted(map(tuple, features.aggregate_to_partner_level(tx.repartition(5)).collect()))
    assert a == b
