"""Exploration operators: edge cases the oracles do not reach."""

from __future__ import annotations

import numpy as np
import pytest

from partnerwatch.operators import explore
from tests.conftest import frame


def test_histogram_last_bin_closed(spark):
    df = frame(spark, {"x": [0.0, 1.0, 2.0, 10.0]})
    rows = {r.bin: r["count"] for r in explore.histogram(df, "x", 5).collect()}
    assert rows == {0: 2, 1: 1, 4: 1}


def test_histogram_constant_column(spark):
    df = frame(spark, {"x": [3.0, 3.0]})
    assert [(r.bin, r["count"]) for r in explore.histogram(df, "x", 10).collect()] == [(0, 2)]


def test_skew_matches_bias_corrected_formula(spark):
    v = [1.0, 2.0, 2.0, 3.0, 9.0, 14.0]
    out = explore.feature_skew(frame(spark, {"a": v}), ["a"]).collect()[0]
    x = np.array(v)
    n = len(x)
    m2, m3 = ((x - x.mean()) ** 2).mean(), ((x - x.mean()) ** 3).mean()
    assert out.skew == pytest.approx(m3 / m2 ** 1.5 * np.sqrt(n * (n - 1)) / (n - 2))
    assert out.highly_skewed is False


def test_skew_needs_three_values(spark):
    assert explore.feature_skew(frame(spark, {"a": [1.0, 2.0]}), ["a"]).collect()[0].skew is None


def test_correlation_constant_column_is_null(spark):
    df = frame(spark, {"a": [1.0, 2.0, 3.0], "b": [2.0, 4.0, 6.5], "c": [5.0, 5.0, 5.0]})
    r = {(x.feature_a, x.feature_b): x.r for x in explore.feature_correlation(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
    assert r[("a", "c")] is None and r[("b", "c")] is None


def test_segment_overview_percentages(spark):
    df = frame(spark, {"Segment": ["A", "A", "A", "B"], "Amount": [1.0, 2.0, 3.0, 4.0],
                       "BusinessPartner": ["p", "p", "q", "r"]})
    rows = {r.Segment: r for r in explore.segment_overview(df).collect()}
    assert rows["A"].PctTransactions == 75.0 and rows["A"].UniquePartners == 2 and rows["A"].AvgAmount == 2.0


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, {"Segment": ["s"] * 300, "v": [float(x) for x in rng.normal(size=300)]})
    d = sorted((r.x, r.density) for r in explore.segment_density(df, "v", "Segment", 1.0, 400, 5, 1).collect())
    xs, ys = np.array([p[0] for p in d]), np.array([p[1] for p in d])
    assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=0.02)
