"""Row signals, labels, netting and peer z-scores."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from partnerwatch.operators import features as FT
from partnerwatch.operators import peers
from tests.conftest import by_key, frame

LEDGER = "BusinessPartner string, CADocumentType string, Amount double"


def ledger(spark, *lines):
    return spark.createDataFrame(list(lines), LEDGER)


def of_amounts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "Amount double")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_document_type_indicators(spark):
    df = ledger(spark, ("k", "ZC", 7.0), ("k", "AC", 8.0), ("m", "RV", 9.0), ("m", None, 1.0))
    out = FT.add_reversal_flags(df).collect()
    assert [(r.ACDocCount, r.ZCDocCount) for r in out] == [(0, 1), (1, 0), (0, 0), (0, 0)]


@pytest.mark.parametrize("amount, high, extreme", [(40.0, 0, 0), (40.01, 1, 0), (900.0, 1, 0), (900.5, 1, 1), (None, 0, 0)])
def test_value_flags_are_strict(spark, amount, high, extreme):
    row = FT.add_value_flags(of_amounts(spark, amount), high_threshold=40.0, extreme_threshold=900.0).collect()[0]
    assert (row.IsHighValue, row.IsExtremeValue) == (high, extreme)


@pytest.mark.parametrize("amount", [0.0, 37.0, 250.0, 262.5, 480.0, 1010.0, 99_999.0])
def test_closeness_to_limits_is_the_best_kernel(spark, amount):
    limits, width = (250.0, 800.0), 0.2
    want = max(math.exp(-0.5 * ((amount - x) / (width * x)) ** 2) for x in limits)
    got = column(FT.add_ros_score(of_amounts(spark, amount), authority_limits=limits, bandwidth=width), "ROSScore")[0]
    assert got == pytest.approx(want, abs=1e-12) and 0.0 <= got <= 1.0


def test_closeness_of_an_unknown_amount_is_unknown(spark):
    assert column(FT.add_ros_score(of_amounts(spark, None)), "ROSScore") == [None]


def test_round_amounts(spark):
    out = FT.add_round_flags(of_amounts(spark, 60.0, 75.0, 25.5, 0.0, -60.0, 20.0), round_thresholds=[20, 25])
    assert [(r.IsRound20, r.IsRound25, r.IsRoundAny) for r in out.collect()] == [
        (1, 0, 1), (0, 1, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 0, 1)]
    assert column(FT.add_round_flags(of_amounts(spark, 14.0, 15.0), round_thresholds=[7]), "IsRoundAny") == [1, 0]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xy"), st.sampled_from(["AC", "ZC", "RV"]), st.sampled_from([3.0, 3.004, 4.5])),
                min_size=1, max_size=14))
def test_netting_marks_keys_with_both_types(spark, lines):
    got = sorted((r.BusinessPartner, r.CADocumentType, r.Amount, r.IsNetted)
                 for r in FT.net_cancellation_pairs(ledger(spark, *lines)).collect())
    types = {}
    for p, t, a in lines:
        types.setdefault((p, round(a, 2)), set()).add(t)
    want = sorted((p, t, a, int(t != "RV" and {"AC", "ZC"} <= types[p, round(a, 2)])) for p, t, a in lines)
    assert got == want


def test_netting_counts(spark):
    df = ledger(spark, ("q", "ZC", 5.0), ("q", "ZC", 5.0), ("q", "AC", 5.0), ("r", "AC", 6.0), ("s", "ZC", 6.0))
    row = FT.netting_summary(FT.net_cancellation_pairs(df)).collect()[0]
    assert (row.netted_rows, row.netted_partners) == (3, 1)


def test_labels_of_known_and_unknown_codes(spark):
    df = spark.createDataFrame([("Z4", "0600"), ("??", "??"), (None, None)],
                               "CAAccountDeterminationCode string, CAMainTransaction string")
    assert column(FT.add_segment_label(df), "Segment") == ["Corporate", "Unknown", "Unknown"]
    assert column(FT.add_transaction_type_label(df), "TransactionType") == ["Adjustment", "Other", "Other"]


def test_peer_group_uses_what_there_is(spark):
    def group(**columns):
        return FT.add_peer_group(frame(spark, {k: [v] for k, v in columns.items()})).collect()[0].PeerGroup

    assert group(Segment="A", TransactionType="B") == "A_B"
    assert group(Segment="A") == "A"
    assert group(other=1) == "ALL"
    assert group(Segment="A", TransactionType="B", PeerGroup="own") == "own"


def test_zscores_compare_within_the_group(spark):
    df = frame(spark, {"BusinessPartner": list("abcdefg"), "PeerGroup": ["u"] * 4 + ["w"] * 2 + ["alone"],
                       "v": [2.0, 4.0, 4.0, 6.0, 900.0, 900.0, 5.0]})
    z = by_key(peers.add_peer_zscores(df, cols=["v"], segment_col="PeerGroup"), "BusinessPartner", "v_zscore")
    sd = math.sqrt(8 / 3)
    assert [z[k] for k in "abcd"] == pytest.approx([-2 / sd, 0, 0, 2 / sd])
    assert z["e"] == z["f"] == 0.0 and z["g"] is None
