"""Execute selected queries and tabulate the operators of their final adaptive
plans (markdown on stdout).

usage: python scripts/plan_report.py [sf_dir] [key ...]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from partnerwatch.plans import registry  # noqa: E402
from partnerwatch.session import local_session  # noqa: E402

DEFAULT_KEYS = ["net_pairs", "partner_rollup", "peer_zscores", "iqr_flags", "flag_reason", "dedup_within_run",
                "cooldown_fresh", "feature_corr", "segment_density", "if_scores", "odata_land"]

NODES = {
    "shuffle": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobinPartitioning|\bExchange SinglePartition",
    "range": r"Exchange rangepartitioning",
    "broadcast": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash_agg": r"\bHashAggregate",
    "obj_agg": r"ObjectHashAggregate",
    "sort_agg": r"SortAggregate",
    "window": r"\bWindow \[",
    "python": r"FlatMapGroupsInPandas|FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInPandas",
    "reused": r"ReusedExchange",
    "scan": r"FileScan parquet|Scan parquet",
}


def final_plan(df) -> str:
    """The plan AQE actually ran (initial-plan sections cut from subqueries)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    text = plan.toString()
    return re.sub(r"\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", text, flags=re.S)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or DEFAULT_KEYS
    spark = local_session(cores=4, shuffle_partitions=8)
    cols = list(NODES)
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for key in keys:
        text = final_plan(registry.QUERIES[key](spark, sf_dir))
        counts = [len(re.findall(NODES[c], text)) for c in cols]
        print(f"| `{key}` | " + " | ".join(str(n) for n in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
