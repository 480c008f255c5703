"""Dedup, cooldown, history log, reasons and rankings.

``as_of`` is explicit and the cooldown covers [as_of - N days, as_of), so a
rerun on the same day sees nothing recent.
"""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from partnerwatch.operators import alerts
from partnerwatch.schemas import HISTORY_SCHEMA
from partnerwatch.sources import files
from tests.conftest import frame

DAY = date(2031, 7, 15)
FLAGGED = ("BusinessPartner string, Segment string, PeerGroup string, isolation_forest_flag boolean, iqr_flag boolean, "
           "risk_score double, ReversalRatio double, TotalAmount double, MaxSingleAmount double, flag_reason string, "
           "iqr_triggered_cols string")


def flagged(spark, *rows):
    """(partner, forest flag, iqr flag, risk) rows, the rest derived."""
    return spark.createDataFrame([(p, "S", "S_T", a, b, r, 10 * (r or 0), 1000.0 * (r or 0), 7.0, f"why {p}", "x")
                                  for p, a, b, r in rows], FLAGGED)


@pytest.fixture
def three(spark):
    return flagged(spark, ("n1", True, False, 0.2), ("n2", True, True, 0.4), ("n3", False, True, 0.3))


def log_of(spark, *entries):
    return spark.createDataFrame([(p, DAY - timedelta(days=d)) for p, d in entries], "BusinessPartner string, run_date date")


def names(df):
    return sorted(r.BusinessPartner for r in df.select("BusinessPartner").collect())


TIER = {(True, True): 3, (False, True): 2, (True, False): 1, (False, False): 0}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pqr"), st.booleans(), st.booleans(), st.sampled_from([0.1, 0.5, 0.9])), max_size=10))
def test_one_row_a_partner_best_tier_then_risk(spark, rows):
    out = alerts.deduplicate_within_run(flagged(spark, *rows))
    got = {r.BusinessPartner: (TIER[r.isolation_forest_flag, r.iqr_flag], r.risk_score) for r in out.collect()}
    want = {}
    for p, a, b, r in rows:
        want[p] = max(want.get(p, (-1, 0)), (TIER[a, b], r))
    assert got == want and out.count() == len(want)


@pytest.mark.parametrize("days, held", [(0, False), (1, True), (14, True), (15, False), (-3, False)])
def test_cooldown_window(spark, three, days, held):
    fresh, suppressed = alerts.filter_recently_alerted(three, log_of(spark, ("n2", days)), DAY, cooldown_days=14)
    assert names(suppressed) == (["n2"] if held else [])
    assert names(fresh) == (["n1", "n3"] if held else ["n1", "n2", "n3"])
    assert fresh.columns == suppressed.columns == three.columns


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(new=st.lists(st.sampled_from("abcde"), max_size=8),
       hist=st.lists(st.tuples(st.sampled_from("abcx"), st.integers(-5, 40)), max_size=8))
def test_cooldown_splits_every_alert_once(spark, new, hist):
    df = spark.createDataFrame([(p, 0.5) for p in new], "BusinessPartner string, risk_score double")
    fresh, suppressed = alerts.filter_recently_alerted(df, log_of(spark, *hist), DAY, cooldown_days=30)
    recent = {p for p, d in hist if 1 <= d <= 30}
    assert names(suppressed) == sorted(p for p in new if p in recent)
    assert names(fresh) == sorted(p for p in new if p not in recent)


def test_history_keeps_days_and_replaces_a_rerun(spark, three, tmp_path):
    path = str(tmp_path / "log")
    empty = files.read_history(spark, path)
    assert empty.count() == 0 and empty.schema == HISTORY_SCHEMA
    files.write_history(three, path, DAY)
    files.write_history(three.filter("iqr_flag"), path, DAY + timedelta(days=1))
    log = files.read_history(spark, path)
    assert log.schema == HISTORY_SCHEMA
    assert log.groupBy("run_date").count().orderBy("run_date").collect() == [(DAY, 3), (DAY + timedelta(days=1), 2)]
    files.write_history(three.filter("risk_score > 0.35"), path, DAY)
    assert names(files.read_history(spark, path).filter(f"run_date = '{DAY}'")) == ["n2"]
    files.write_history(three.limit(0), path, DAY)
    assert files.read_history(spark, path).filter(f"run_date = '{DAY}'").count() == 0
    assert files.read_history(spark, path).count() == 2


def test_withdrawn_alert_does_not_suppress(spark, three, tmp_path):
    path = str(tmp_path / "log")
    files.write_history(three, path, DAY)
    files.write_history(three.limit(0), path, DAY)
    nxt = alerts.run_full_deduplication(three, files.read_history(spark, path), DAY + timedelta(days=1), 30)
    assert names(nxt.fresh) == ["n1", "n2", "n3"]


def test_two_runs(spark, three, tmp_path):
    path = str(tmp_path / "log")
    first = alerts.run_full_deduplication(three.unionByName(three), files.read_history(spark, path), DAY, 30)
    assert tuple(alerts.alert_summary(first).collect()[0]) == (3, 3, 0)
    files.write_history(first.fresh, path, DAY)
    assert names(first.history) == ["n1", "n2", "n3"]
    more = three.unionByName(flagged(spark, ("n9", True, True, 0.7)))
    second = alerts.run_full_deduplication(more, files.read_history(spark, path), DAY + timedelta(days=2), 30)
    assert tuple(alerts.alert_summary(second).collect()[0]) == (4, 1, 3)
    assert names(second.fresh) == ["n9"]


def reason_of(spark, **columns) -> str:
    base = {"PeerGroup": "Retail", "iqr_triggered_cols": "", "isolation_forest_flag": False, "iqr_flag": True,
            "risk_score": 0.25, "Balance": 0.0, "ReversalRatio": 1.0, "AvgROSScore": 0.0}
    return alerts.build_alert_column(frame(spark, {k: [v] for k, v in (base | columns).items()})).collect()[0].flag_reason


@pytest.mark.parametrize("column, value, score, text", [
    ("ReversalRatio", 3.25, 2.75, "ReversalRatio 3.2x is 2.8 IQRs above Retail peers"),
    ("AvgROSScore", 0.65, 4.0, "Average transaction amount is suspiciously close to authority limits "
                               "(ROS score 0.65, 4.0 IQRs above Retail peers)"),
    ("RoundTransactionRate", 0.5, 6.5, "50% of transactions are round numbers (6.5 IQRs above Retail peers)"),
    ("NettedPairsCount", 2048.0, 3.0, "2,048 AC/ZC cancellation pairs detected (3.0 IQRs above Retail peers)"),
    ("Balance", 81_234.5, 2.5, "Balance $81,234 is 2.5 IQRs above Retail peers"),
    ("MaxDaysOverdue", 44.0, 2.25, "MaxDaysOverdue (44.0) is 2.2 IQRs above Retail peers"),
])
def test_reason_of_each_metric(spark, column, value, score, text):
    got = reason_of(spark, **{column: value, f"{column}_iqr_score": score, "iqr_triggered_cols": column})
    assert got == text


def test_reasons_join_in_order_and_rules_follow(spark):
    got = reason_of(spark, iqr_triggered_cols="TotalDebit, NettedPairsCount", TotalDebit=10.0, TotalDebit_iqr_score=2.5,
                    NettedPairsCount=3.0, NettedPairsCount_iqr_score=9.0, ReversalRatio=6.5, AvgROSScore=0.8, Balance=300_000.0)
    assert got.split("; ")[1:] == [
        "3 AC/ZC cancellation pairs detected (9.0 IQRs above Retail peers)", "ReversalRatio 6.5x exceeds 5.0x threshold",
        "Avg transaction amount near authority limit (ROS score 0.80)", "Balance $300,000 exceeds $100,000 threshold"]


def test_reason_of_the_forest_alone_and_of_no_flag(spark):
    assert reason_of(spark, isolation_forest_flag=True, iqr_flag=False) == (
        "Flagged by Isolation Forest within Retail peer group (risk score 0.25); "
        "no single metric exceeded IQR threshold -- review full profile")
    assert reason_of(spark, iqr_flag=False, Balance=900_000.0, ReversalRatio=50.0) == ""


def test_reason_falls_back_to_the_segment(spark):
    row = frame(spark, {"Segment": ["Wholesale"], "iqr_triggered_cols": [""], "isolation_forest_flag": [True],
                        "iqr_flag": [False], "risk_score": [0.5]})
    assert "within Wholesale peer group" in alerts.build_alert_column(row).collect()[0].flag_reason


def test_rankings(spark, three):
    assert [r.BusinessPartner for r in alerts.watchlist(three).collect()] == ["n2", "n3", "n1"]
    assert "iqr_triggered_cols" not in alerts.watchlist(three).columns
    assert [r.BusinessPartner for r in alerts.show_top(three, "ReversalRatio", n=2).collect()] == ["n2", "n3"]
    top = alerts.top_watchlist(three, n=2).collect()
    assert [(r.BusinessPartner, r.IF, r.IQR) for r in top] == [("n2", "YES", "YES"), ("n3", "no", "YES")]
