"""Plan checks: the library stays declarative and distributed.

* no Python UDF anywhere outside the forest's fit/score stages;
* per-group statistics with a proven group bound are broadcast;
* exact quantiles never use Spark's single-buffer ``percentile``;
* filters and column pruning reach the Parquet scan;
* nothing in the library collects to the driver (``tests/llm`` lists the bounded
  fetches of the training-data operators).
"""

from __future__ import annotations

import re
from pathlib import Path

from partnerwatch import config as C
from partnerwatch.operators import peers
from partnerwatch.plans import pipeline as P
from partnerwatch.plans import registry
from partnerwatch.sources import fixtures as FX

SF = "/root/testdata/sf0.001"
PKG = Path(__file__).resolve().parents[1] / "partnerwatch"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_without_forest_has_no_python(spark):
    gold = P.score_partners(P.fixture_partners(spark, SF), with_forest=False)
    text = plan(gold)
    assert "Python" not in text and "ArrowEval" not in text and "FlatMap" not in text


def test_group_statistics_are_broadcast(spark):
    z = peers.add_peer_zscores(P.fixture_partners(spark, SF), list(C.ZSCORE_COLUMNS), "PeerGroup",
                               C.peer_group_bound())
    assert "BroadcastHashJoin" in plan(z) or "BroadcastExchange" in plan(z)


def test_quantiles_do_not_use_single_buffer_percentile(spark):
    s = peers.score_features_by_segment(P.fixture_partners(spark, SF), list(C.MODEL_FEATURES), "PeerGroup")
    text = plan(s).lower()
    assert "percentile(" not in text and "percentile_approx" not in text
    assert "rangepartitioning" in text


def test_scan_pushdown_and_pruning(spark):
    df = FX.table(spark, SF, "events").filter("event_type = 'error'").select("user_id")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in text
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", text)


# rows of run manifests: one for each part of a table, never data
BOUNDED_FETCHES = {"publish.py: .toLocalIterator()"}


def test_no_driver_collection_in_library():
    offenders = []
    for f in PKG.rglob("*.py"):
        if "llm" in f.relative_to(PKG).parts:
            continue
        src = f.read_text()
        for pat in (".collect()", ".toPandas()", "localCheckpoint", ".take(", ".first()", ".toArrow()",
                    ".toLocalIterator()"):
            if pat in src:
                offenders.append(f"{f.name}: {pat}")
    assert set(offenders) == BOUNDED_FETCHES


def test_registry_is_consistent():
    qs, oracles = registry.QUERIES, registry.ORACLES
    assert set(oracles) <= set(qs)
    assert len(qs) >= 50


def test_no_cross_or_nested_loop_joins(spark):
    from partnerwatch.plans import registry as R

    for key in ("amount_summary", "feature_corr", "risk_score", "alert_summary", "segment_overview", "eda_summary"):
        text = plan(R.QUERIES[key](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key
