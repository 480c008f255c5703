"""Interquartile scores and the Isolation Forest."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from partnerwatch.functions import stats
from partnerwatch.operators import alerts, iforest, peers
from tests.conftest import by_key, frame


@pytest.fixture
def crowd(spark):
    """Thirty ordinary partners and one far from them in both features."""
    rng = np.random.default_rng(11)
    return frame(spark, {"BusinessPartner": [f"c{i}" for i in range(30)] + ["odd"], "Segment": ["one"] * 31,
                         "spend": [*map(float, rng.normal(40, 4, 30)), 900.0],
                         "lag": [*map(float, rng.normal(5, 1, 30)), 77.0]})


def one_group(spark, values):
    return frame(spark, {"id": list(range(len(values))), "g": ["only"] * len(values), "v": [float(v) for v in values]})


@pytest.mark.parametrize("values", [[3, 8, 1, 9, 40], [2, 2, 2, 7, 9, 11, 50, 51], [-5, 0, 5]])
def test_scores_are_distances_above_the_upper_quartile(spark, values):
    low, high = np.quantile(values, [0.25, 0.75])
    got = by_key(peers.iqr_scores(one_group(spark, values), ["v"], "g")[0], "id", "v_iqr_score")
    assert [got[i] for i in range(len(values))] == pytest.approx([(v - high) / (high - low) for v in values])


@pytest.mark.parametrize("values", [[6, 6, 6], [6, 6, 6, 6, 6, 6, 6, 1000]])
def test_a_flat_middle_scores_zero(spark, values):
    got = peers.iqr_scores(one_group(spark, values), ["v"], "g")[0].collect()
    assert {r.v_iqr_score for r in got} == {0.0}


def test_flags_name_the_features_beyond_the_fence(crowd):
    out = peers.score_features_by_segment(crowd, ["lag", "spend"], "Segment", 2.0)
    rows = {r.BusinessPartner: r for r in out.collect()}
    assert rows["odd"].iqr_flag and rows["odd"].iqr_triggered_cols == "lag, spend"
    assert rows["odd"].iqr_max_score == max(rows["odd"].lag_iqr_score, rows["odd"].spend_iqr_score)
    assert not rows["c0"].iqr_flag and rows["c0"].iqr_triggered_cols == ""
    whole = peers.score_features_by_segment(crowd, ["spend"], segment_col=None)
    assert by_key(whole, "BusinessPartner", "iqr_flag")["odd"] is True


def test_without_features_nothing_is_flagged(crowd):
    r = peers.score_features_by_segment(crowd, ["absent"], "Segment").collect()[0]
    assert (r.iqr_flag, r.iqr_max_score, r.iqr_triggered_cols) == (False, 0.0, "")


def test_bounded_targets_are_the_broadcast_side(spark):
    df = one_group(spark, range(50))
    plan = stats.group_quantiles(df, ["g"], ["v"], (0.5,), group_bound=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    loose = stats.group_quantiles(df, ["g"], ["v"], (0.5,))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in loose


def forest(df, **options):
    return iforest.run_isolation_forest_by_segment(df, ["spend", "lag"], "Segment", **options)


def test_forest_ranks_the_odd_partner_first(crowd):
    out = forest(crowd, contamination=0.05)
    risk = by_key(out, "BusinessPartner", "risk_score")
    assert risk["odd"] == 1.0 and min(risk.values()) == 0.0 and len(risk) == 31
    assert by_key(out, "BusinessPartner", "isolation_forest_flag")["odd"] is True


def test_forest_does_not_depend_on_partitions(crowd):
    score = lambda df: by_key(forest(df, n_estimators=25), "BusinessPartner", "isolation_forest_score")
    assert score(crowd) == score(crowd.repartition(5))


@pytest.mark.parametrize("rows", [1, 2, 3])
def test_forest_of_very_few_partners_is_defined(crowd, rows):
    out = forest(crowd.orderBy("BusinessPartner").limit(rows), n_estimators=10).collect()
    assert len(out) == rows
    assert all(r.risk_score is not None and 0.0 <= r.risk_score <= 1.0 and r.isolation_forest_flag is not None for r in out)
    if rows == 1:
        assert out[0].isolation_forest_flag is False


def test_small_groups_go_to_the_global_model(spark):
    df = frame(spark, {"BusinessPartner": [f"q{i}" for i in range(9)], "Seg": ["large"] * 6 + ["small"] * 3})
    route = by_key(iforest.model_routing(df, "Seg", min_segment_size=5), "BusinessPartner", "model_key")
    assert {route["q0"], route["q5"]} == {"large"} and {route["q6"], route["q8"]} == {"__GLOBAL__"}


def test_expected_path_lengths():
    harmonic = lambda n: sum(1 / k for k in range(1, n + 1))
    assert [iforest.average_path_length(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    for n in (50, 1000):
        assert iforest.average_path_length(n) == pytest.approx(2 * harmonic(n - 1) - 2 * (n - 1) / n, abs=0.03)


def test_flagged_partners_get_reasons(crowd):
    scored = peers.score_features_by_segment(crowd, ["lag", "spend"], "Segment", 2.0)
    out = alerts.build_alert_column(scored.withColumns({"isolation_forest_flag": F.lit(False), "risk_score": F.lit(0.5)}))
    reasons = by_key(out, "BusinessPartner", "flag_reason")
    flags = by_key(out, "BusinessPartner", "iqr_flag")
    assert all(bool(reasons[p]) == flags[p] for p in reasons) and "lag (77.0) is" in reasons["odd"]
