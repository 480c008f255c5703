"""The partner rollup from one bucketed table of ledger lines: the rows of the row path,
without a shuffle of the lines by partner."""

from __future__ import annotations

from datetime import date

import pytest

from partnerwatch.operators import features, rollup
from partnerwatch.plans import pipeline as P

AS_OF = date(2002, 1, 1)
SCHEMA = ("BusinessPartner string, BusinessPartnerName string, ContractAccount string, CADocumentNumber string, CADocumentType string, "
          "CAMainTransaction string, CAAccountDeterminationCode string, Amount double, Balance double, TotalDebit double, "
          "TotalCredit double, NumberOfItems int, NetDueDate timestamp")


@pytest.fixture
def silver(spark):
    from datetime import datetime

    rows = []
    for i in range(400):
        partner = "BUSY" if i % 4 == 0 else f"P{i % 23}"
        kind, amount = ["AC", "ZC", "RV", None][i % 7 % 4], [5.0, 5.004, 7.5, None, float("nan"), 20_000.0][i % 11 % 6]
        rows.append((partner, None if i % 5 == 0 else f"name {i % 3}", f"c{i % 6}" if i % 9 else None, f"{i % 300:05d}", kind,
                     ["R000", "0060", None][i % 3], ["Z1", "Z9", None][i % 13 % 3], amount, float(i % 10), 2.0, 0.5, i % 8,
                     datetime(2001, 1, 1 + i % 28) if i % 6 else None))
    return spark.createDataFrame(rows * 2, SCHEMA)


def told(df):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("most", [10_000, 60, 0])
def test_lines_roll_up_as_flagged_rows_do(silver, most):
    rows = features.aggregate_to_partner_level(P.transactions(silver, AS_OF))
    new = P.rolled_lines(silver, AS_OF, most=most)
    assert new.columns == rows.columns and told(new) == told(rows)


def test_folded_lines_of_busy_partners(silver):
    silver = silver.filter("not isnan(Amount)")
    new = P.rolled_lines(silver, AS_OF, folded=True, most=60)
    assert told(new) == told(P.rolled_lines(silver, AS_OF, folded=True))
    assert told(new.select("BusinessPartner", "TotalTransactions", "NettedPairsCount", "UniqueContracts")) == told(
        P.rolled_lines(silver, AS_OF).select("BusinessPartner", "TotalTransactions", "NettedPairsCount", "UniqueContracts"))


def test_partners_shuffle_no_line(spark, silver):
    """The lines are read by partner; only counts of busy partners are shuffled by it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = P.partners(silver, AS_OF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    few = plan.split("BroadcastExchange")[0]
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in few


def test_ledger_without_lines(silver):
    for folded in (False, True):
        assert P.rolled_lines(silver.filter("Amount = -1"), AS_OF, folded=folded).count() == 0


def test_groups_of_busy_partners_roll_up_alike(silver):
    groups = rollup.ledger_groups(P.signals(silver.filter("not isnan(Amount)"), AS_OF)).persist()
    plain = rollup.rollup_groups(groups)
    for most in (10_000, 20, 0):
        new = rollup.rollup_table(groups, most=most)
        assert new.columns == plain.columns and told(new) == told(plain)
    few = rollup.rollup_table(groups)._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "Bucketed: true" in few and "Exchange hashpartitioning" not in few


def test_document_numbers_as_lpad_makes_them(spark):
    """Slices of zeros give the padded text, null parts are skipped and long ones cut as ``lpad`` does."""
    from pyspark.sql import functions as F

    from partnerwatch.sources import fixtures as FX

    top = 2 ** 63 - 1
    rows = [(1, 2, 3, 4, 5.5), (top, 7, top, top, 12345678.905), (-5, -1, -3, 0, -0.01), (-top, 1, 10 ** 18, -(10 ** 18), 1.0),
            (None, 1, 2, 3, 4.0), (1, None, 2, 3, 4.0), (1, 2, None, 3, None), (None, None, None, None, None), (9, 9, 9, 9, 0.005)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    keys = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    old = F.concat_ws("-", *(F.lpad(c.cast("string"), 19, "0") for c in [*keys, cents]))
    got = df.select(FX.document_number().alias("new"), old.alias("old")).collect()
    assert [r.new for r in got] == [r.old for r in got] and got[0].new.startswith("0" * 18 + "1-")
    plan = df.select(FX.document_number())._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" in plan  # most rows never reach lpad
