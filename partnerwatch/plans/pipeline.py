"""Compositions (X1-X4): bronze -> silver -> transactions -> partners -> gold.

Every function returns a lazy DataFrame; the job functions at the bottom are
the only places that write.
"""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.operators import alerts, features, iforest, peers, rollup, silver
from partnerwatch.session import cut_by_key, cut_lineage
from partnerwatch.sources import fixtures

log = logging.getLogger("partnerwatch")


def signals(silver_df: DataFrame, as_of: date, cfg: C.Settings = C.DEFAULTS, clip_negative: bool = False) -> DataFrame:
    """Silver rows with days overdue and every row signal."""
    tx = silver.add_days_overdue(silver_df, as_of, clip_negative=clip_negative)
    return features.add_transaction_signals(tx, cfg.signals)


def transactions(silver_df: DataFrame, as_of: date, cfg: C.Settings = C.DEFAULTS,
                 clip_negative: bool = False) -> DataFrame:
    """``signals`` with the netting flag of each row."""
    return features.net_cancellation_pairs(signals(silver_df, as_of, cfg, clip_negative))


def partners(silver_df: DataFrame, as_of: date, cfg: C.Settings = C.DEFAULTS,
             clip_negative: bool = False, folded: bool = False) -> DataFrame:
    """One row per partner with its rollup features and ``PeerGroup``.

    ``folded`` takes the one-scan path of ``operators.rollup``: right where many rows
    share a partner, amount, document type and contract, so that folding them makes
    them few. Without it the rows are flagged and rolled up, which is faster where
    nearly every row is a group of its own, as in the given tables.
    """
    return features.add_peer_group(rolled_lines(silver_df, as_of, cfg, clip_negative, folded))


#: What the rollup reads of a silver row, beside the column that orders the rows.
LINE_COLUMNS = ("BusinessPartner", "BusinessPartnerName", "ContractAccount", "CADocumentType", "CAMainTransaction",
                "CAAccountDeterminationCode", "Amount", "Balance", "TotalDebit", "TotalCredit", "NumberOfItems", "NetDueDate")


def rolled_lines(silver_df: DataFrame, as_of: date, cfg: C.Settings = C.DEFAULTS, clip_negative: bool = False,
                 folded: bool = False, most: int | None = None) -> DataFrame:
    """J1, J3 and A1 of silver rows that are written once, bucketed by partner.

    Signals are taken from that table, so it holds the silver columns alone; netting,
    sums, first values and distinct counts find a partner's rows in one task. Partners of more than ``most`` rows (``features.BUSY_ROWS``) go by row netting
    and aggregates combined map side. With ``folded`` both go by ledger groups."""
    order = cfg.signals.first_by
    wanted = [c for c in dict.fromkeys([*LINE_COLUMNS, order]) if c in silver_df.columns]
    by_partner, lines = cut_by_key(silver_df.select(*wanted), "BusinessPartner", "ledger-lines")
    few, busy = features.split_busy(by_partner, lines, most=most)
    few, busy = signals(few, as_of, cfg, clip_negative), signals(busy, as_of, cfg, clip_negative)
    if folded:
        groups = rollup.ledger_groups(few, order_col=order).unionByName(rollup.ledger_groups(busy, order_col=order))
        return rollup.rollup_table(groups, most=most)
    local, spread = features.net_within_partners(few), features.net_cancellation_pairs(busy)
    return features.aggregate_to_partner_level(local, order_col=order, together=True).unionByName(
        features.aggregate_to_partner_level(spread, order_col=order))


def score_partners(partner_df: DataFrame, cfg: C.Settings = C.DEFAULTS,
                   group_col: str = "PeerGroup", with_forest: bool = True) -> DataFrame:
    """z-scores, IQR scores/flags, Isolation Forest and the alert reason."""
    by = cfg.scoring
    # the bound holds for keys made of the label tables, not for a caller's own PeerGroup column
    labelled = {"Segment", "TransactionType"} <= set(partner_df.columns)
    bound = C.peer_group_bound() if group_col == "PeerGroup" and labelled else None
    # the partner table feeds z-scores, quantiles, sampling, scoring and the
    # final joins: write it once instead of recomputing the ledger plan each time
    partner_df = cut_lineage(partner_df, "partners")
    scored = peers.add_peer_zscores(partner_df, by.zscored, group_col, bound)
    scored = peers.score_features_by_segment(scored, by.features, group_col, by.fence, bound)
    if with_forest:
        scored = iforest.run_isolation_forest_by_segment(
            scored, by.features, group_col, contamination=by.contamination, n_estimators=by.trees,
            random_state=by.seed, min_segment_size=by.smallest_group, group_bound=bound)
    return alerts.build_alert_column(
        scored, iqr_multiplier=by.fence,
        suspicious_reversal_ratio=cfg.alerting.reversal_ratio,
        high_balance_threshold=cfg.alerting.balance,
        high_ros_score=cfg.alerting.ros,
    )


def build_gold(silver_df: DataFrame, as_of: date, cfg: C.Settings = C.DEFAULTS,
               with_forest: bool = True) -> DataFrame:
    """X2 up to the gold table."""
    return score_partners(partners(silver_df, as_of, cfg), cfg, with_forest=with_forest)


def fixture_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed silver rows of the fixture ledger (as read from a silver table)."""
    return fixtures.ledger_silver(spark, sf_dir)


def fixture_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture ledger through the X1 silver job (text bronze -> typed)."""
    return silver.build_silver(fixtures.ledger_bronze(spark, sf_dir))


def fixture_partners(spark: SparkSession, sf_dir: str, cfg: C.Settings = C.DEFAULTS) -> DataFrame:
    return partners(fixture_silver(spark, sf_dir), fixtures.LEDGER_AS_OF, cfg)


# ------------------------------------------------------------------ jobs
def run_staging(spark: SparkSession, at: C.Tables, drop_columns: tuple[str, ...] = C.BRONZE_DROP_COLUMNS) -> dict:
    """X1 job: bronze CSV -> silver Parquet. Raw and kept row counts are
    observed during the one write (S9), not counted by extra scans."""
    from partnerwatch.sources import files

    raw_obs, kept_obs = Observation("bronze"), Observation("silver")
    bronze = files.read_bronze_csv(spark, at.path("bronze"))
    out = silver.build_silver(silver.drop_columns(bronze, drop_columns), raw_obs)
    out = out.observe(kept_obs, F.count(F.lit(1)).alias("silver_rows"))
    files.write_silver(out, at.path("silver"))
    counts = {**raw_obs.get, **kept_obs.get}
    log.info("staging: %s raw rows, %s silver rows", counts.get("raw_rows"), counts.get("silver_rows"))
    return counts


def run_curated(spark: SparkSession, as_of: date, at: C.Tables, cfg: C.Settings = C.DEFAULTS) -> dict:
    """X2 job: silver -> gold Parquet, alert dedup + cooldown, watchlist, history.

    The gold table is written first and read back, which cuts the lineage of
    the model stages; the watchlist is written before the history so a failure
    in between cannot lose alerts (Q18).
    """
    from partnerwatch.sources import files

    silver_df = files.read_silver(spark, at.path("silver"))
    gold_obs = Observation("gold")
    gold = build_gold(silver_df, as_of, cfg).observe(
        gold_obs, F.count(F.lit(1)).alias("partners"), F.count_if(F.col("iqr_flag")).alias("iqr_flagged"),
        F.count_if(F.col("isolation_forest_flag")).alias("if_flagged"),
        F.count_if(F.col("iqr_flag") & F.col("isolation_forest_flag")).alias("both_flagged"))
    files.write_gold(gold, at.path("gold"))
    log.info("gold: %s", gold_obs.get)
    gold = files.read_gold(spark, at.path("gold"))

    flagged = gold.filter(F.col("isolation_forest_flag") | F.col("iqr_flag"))
    history = files.read_history(spark, at.path("history"))
    result = alerts.run_full_deduplication(flagged, history, as_of, cfg.alerting.cooldown_days)
    files.write_watchlist(alerts.watchlist(result.fresh, cfg.alerting.columns), at.path("watchlist"))
    files.write_history(result.fresh, at.path("history"), as_of)
    return {"fresh": result.fresh, "suppressed": result.suppressed}


def publish_curated(spark: SparkSession, as_of: date, silver_df: DataFrame, base: str,
                    cfg: C.Settings = C.DEFAULTS) -> dict:
    """X2 job, published as one run: gold, watchlist and the day's history are
    written to folders of this run and become visible together; a run that stops in
    between leaves the tables as they were. A rerun of a day replaces its history."""
    from partnerwatch.schemas import HISTORY_SCHEMA
    from partnerwatch.sources import files, publish

    run = publish.Run(base, f"curated-{as_of.isoformat()}")
    gold = spark.read.parquet(run.write(build_gold(silver_df, as_of, cfg), "gold", writer=files.write_gold))
    flagged = gold.filter(F.col("isolation_forest_flag") | F.col("iqr_flag"))
    history = publish.read(spark, base, "history", HISTORY_SCHEMA)
    history = spark.createDataFrame([], HISTORY_SCHEMA) if history is None else history
    result = alerts.run_full_deduplication(flagged, history, as_of, cfg.alerting.cooldown_days)
    run.write(alerts.watchlist(result.fresh, cfg.alerting.columns), "watchlist", writer=files.write_watchlist)
    run.write(files.history_rows(result.fresh, as_of), "history", as_of.isoformat())
    run.publish(spark)
    return {"fresh": result.fresh, "suppressed": result.suppressed}


def run_daily(spark: SparkSession, as_of: date, at: C.Tables, cfg: C.Settings = C.DEFAULTS) -> dict:
    """The daily chain staging -> curated (scheduling itself is external)."""
    run_staging(spark, at)
    return run_curated(spark, as_of, at, cfg)
