"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with seconds per query.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). The session is warmed up (untimed) on the
sf0.01 tables so JVM start-up and JIT compilation are not charged to the first
queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from partnerwatch.plans import pipeline as P  # noqa: E402
from partnerwatch.plans import registry  # noqa: E402
from partnerwatch.session import local_session  # noqa: E402
from partnerwatch.sources import fixtures as FX  # noqa: E402

HEADLINE = [
    "silver_transactions", "net_pairs", "partner_rollup", "peer_zscores", "iqr_flags", "flag_reason",
    "segment_overview", "amount_summary", "feature_describe", "feature_corr", "segment_density",
    "cooldown_fresh", "alert_summary", "odata_land", "if_scores", "contamination_sweep",
]


def gold_pipeline(spark, sf):
    """X2 end to end: silver -> partners -> z / IQR / forest -> reasons."""
    return P.build_gold(P.fixture_silver(spark, sf), FX.LEDGER_AS_OF)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="partnerwatch-bench")
    warm = "/root/testdata/sf0.01"
    if Path(warm).exists():
        for key in ("partner_rollup", "iqr_flags", "net_pairs"):
            run(registry.QUERIES[key](spark, warm))

    todo = {k: registry.QUERIES[k] for k in HEADLINE if k in registry.QUERIES}
    todo["gold_pipeline"] = gold_pipeline
    timings: dict[str, float] = {}
    for key, fn in todo.items():
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        timings[key] = round(time.perf_counter() - t0, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
