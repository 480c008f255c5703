"""spark-submit entry for the daily chain.

    python -m partnerwatch daily --as-of 2024-01-31 --raw <shared>/bronze --silver <shared>/silver \\
        --gold <shared>/gold --watchlist <shared>/watchlist --history <shared>/history

``stage`` runs X1 only, ``curated`` X2 only, ``daily`` both. The session comes
from the submitting cluster (master, memory and ``spark.checkpoint.dir`` are
cluster configuration); scheduling is left to the caller's orchestrator.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace
from datetime import date

from partnerwatch import config as C


def settings_of(args: argparse.Namespace) -> C.Settings:
    if args.cooldown_days is None:
        return C.DEFAULTS
    return replace(C.DEFAULTS, alerting=replace(C.DEFAULTS.alerting, cooldown_days=args.cooldown_days))


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="partnerwatch", description="peer-group anomaly pipeline")
    p.add_argument("step", choices=["stage", "curated", "daily"])
    p.add_argument("--as-of", type=date.fromisoformat, default=date.today(),
                   help="business date of the run (default: today)")
    p.add_argument("--raw")
    p.add_argument("--silver")
    p.add_argument("--gold")
    p.add_argument("--watchlist")
    p.add_argument("--history")
    p.add_argument("--cooldown-days", type=int)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    from pyspark.sql import SparkSession

    from partnerwatch.plans import pipeline

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    args = parse_args(argv)
    cfg = settings_of(args)
    at = C.Tables(args.raw, args.silver, args.gold, args.watchlist, args.history)
    spark = SparkSession.builder.appName("partnerwatch").getOrCreate()
    if args.step == "stage":
        return pipeline.run_staging(spark, at)
    if args.step == "curated":
        return pipeline.run_curated(spark, args.as_of, at, cfg)
    return pipeline.run_daily(spark, args.as_of, at, cfg)


if __name__ == "__main__":
    main()
