"""End-to-end daily chain (X1-X3): bronze CSV -> silver -> gold -> alerts -> watchlist + history."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.plans import pipeline as P
from partnerwatch.schemas import BRONZE_SCHEMA, BRONZE_TEXT_COLUMNS
from partnerwatch.sources import files
from partnerwatch.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_daily_chain(spark, tmp_path):
    raw = str(tmp_path / "raw")
    FX.ledger_bronze(spark, SF).write.option("header", True).csv(raw)
    at = C.Tables(raw, *(str(tmp_path / name) for name in ("silver", "gold", "watchlist", "history")))
    as_of = FX.LEDGER_AS_OF
    out = P.run_daily(spark, as_of, at)

    silver = files.read_silver(spark, at.silver)
    assert silver.count() == 6000
    gold = files.read_gold(spark, at.gold)
    assert gold.count() == 150
    flagged = gold.filter("isolation_forest_flag OR iqr_flag").count()
    assert flagged > 0
    assert gold.filter("(isolation_forest_flag OR iqr_flag) AND flag_reason = ''").count() == 0
    assert gold.filter("NOT (isolation_forest_flag OR iqr_flag) AND flag_reason <> ''").count() == 0

    wl = spark.read.option("header", True).csv(at.watchlist)
    assert wl.count() == flagged == out["fresh"].count()
    assert wl.columns == [c for c in C.WATCHLIST_COLUMNS]
    hist = files.read_history(spark, at.history)
    assert hist.count() == flagged

    # next day: everything flagged again is inside the cooldown
    nxt = P.run_curated(spark, as_of + timedelta(days=1), at)
    assert nxt["fresh"].count() == 0 and nxt["suppressed"].count() == flagged
    assert files.read_history(spark, at.history).count() == flagged


def test_gold_columns(spark):
    gold = P.build_gold(P.fixture_silver(spark, SF), date(2002, 1, 1))
    cols = set(gold.columns)
    assert {f"{c}_iqr_score" for c in C.MODEL_FEATURES} <= cols
    assert {f"{c}_zscore" for c in C.ZSCORE_COLUMNS} <= cols
    assert {"iqr_max_score", "iqr_flag", "iqr_triggered_cols", "isolation_forest_flag", "isolation_forest_score",
            "risk_score", "flag_reason", "PeerGroup"} <= cols
    assert len(gold.columns) == 64


def test_cli_stage_step(spark, tmp_path):
    from partnerwatch.__main__ import main

    raw = str(tmp_path / "raw")
    FX.ledger_bronze(spark, SF).write.option("header", True).csv(raw)
    counts = main(["stage", "--raw", raw, "--silver", str(tmp_path / "silver"), "--as-of", "2002-01-01"])
    assert counts == {"raw_rows": 6000, "silver_rows": 6000}
    assert files.read_silver(spark, str(tmp_path / "silver")).count() == 6000


def test_staging_binds_columns_by_header(spark, tmp_path):
    """Further columns in front and another order: values stay under their names."""
    raw = str(tmp_path / "raw")
    ledger = FX.ledger_bronze(spark, SF)
    names = [*C.BRONZE_DROP_COLUMNS, *reversed(ledger.columns)]
    wide = ledger.select("*", *[F.lit(f"other {i}").alias(c) for i, c in enumerate(C.BRONZE_DROP_COLUMNS)])
    wide.select(*[c for c in names if c != "FirstName"]).write.option("header", True).csv(raw)
    at = C.Tables(bronze=raw, silver=str(tmp_path / "silver"))
    assert P.run_staging(spark, at) == {"raw_rows": 6000, "silver_rows": 6000}
    got = files.read_silver(spark, at.silver)
    assert got.exceptAll(P.fixture_staged(spark, SF)).count() == 0 and got.count() == 6000


def test_bad_amounts_are_rejected_and_counted(spark):
    from partnerwatch.operators import silver as S

    row = dict.fromkeys(BRONZE_TEXT_COLUMNS)
    texts = ["1.5", "Infinity", "-Infinity", "NaN", "1e33", "junk", None, "-2"]
    bronze = spark.createDataFrame([tuple((row | {"BusinessPartner": "p", "AmountInDisplayCurrency": t}).values()) for t in texts], BRONZE_SCHEMA)
    assert sorted(r.Amount for r in S.silver_projection(bronze).collect()) == [1.5, 2.0]
    assert tuple(S.silver_reject_count(bronze).collect()[0]) == (6, 8)


def test_jobs_name_the_path_they_lack(spark):
    with pytest.raises(ValueError, match="bronze"):
        P.run_staging(spark, C.Tables())
