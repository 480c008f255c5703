"""Alert reasons, within-run dedup, cooldown against history, watchlist
(L1-L6, W4, J4, S8, L3).

The reason text is one ``concat_ws`` expression assembled from the column list
at plan time; numbers go through ``format_number`` (half-even on the exact
binary value, like Python's format spec). Dedup is an aggregate (``min`` of a
ranking struct), so a partner with very many alert rows is pre-combined map
side instead of being sorted in one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerwatch import config as C

# ---------------------------------------------------------------------------
# Reason texts (wording must equal the reference's). Placeholders:
# {col} feature name, {peer} peer label, {limit} a threshold as Python prints it;
# numbers take a format spec (.1f / .2f / .0f, a leading "," adds thousands
# separators); {pct} is the value x 100 and {count} the value truncated to an int.
# ---------------------------------------------------------------------------
MONEY_FEATURES = ("TotalAmount", "MaxSingleAmount", "Balance", "TotalDebit")
FEATURE_TEMPLATES = {
    "ReversalRatio": "ReversalRatio {value:.1f}x is {score:.1f} IQRs above {peer} peers",
    "money": "{col} ${value:,.0f} is {score:.1f} IQRs above {peer} peers",
    "AvgROSScore": ("Average transaction amount is suspiciously close to authority limits "
                    "(ROS score {value:.2f}, {score:.1f} IQRs above {peer} peers)"),
    "RoundTransactionRate": "{pct:.0f}% of transactions are round numbers ({score:.1f} IQRs above {peer} peers)",
    "NettedPairsCount": "{count:,} AC/ZC cancellation pairs detected ({score:.1f} IQRs above {peer} peers)",
    "other": "{col} ({value:.1f}) is {score:.1f} IQRs above {peer} peers",
}
RULE_REVERSAL = "ReversalRatio {value:.1f}x exceeds {limit}x threshold"
RULE_ROS = "Avg transaction amount near authority limit (ROS score {value:.2f})"
RULE_BALANCE = "Balance ${value:,.0f} exceeds ${limit:,.0f} threshold"
IF_ONLY = ("Flagged by Isolation Forest within {peer} peer group (risk score {risk:.2f}); "
           "no single metric exceeded IQR threshold -- review full profile")
REASON_SEPARATOR = "; "
# ---------------------------------------------------------------------------

_PLACEHOLDER = re.compile(r"\{(\w+)(?::([^}]*))?\}")


def feature_template(name: str) -> str:
    if name in MONEY_FEATURES:
        return FEATURE_TEMPLATES["money"]
    return FEATURE_TEMPLATES.get(name, FEATURE_TEMPLATES["other"])


def _num(x: Column, spec: str) -> Column:
    """Python's ``format(x, spec)`` for specs ``[,].Nf`` and ``,`` via ``format_number``
    (half-even on the exact binary value, as Python rounds)."""
    thousands = spec.startswith(",")
    body = spec.lstrip(",")
    decimals = int(body[1:-1]) if body.startswith(".") and body.endswith("f") else 0
    text = F.format_number(x.cast("double"), decimals)
    return text if thousands else F.translate(text, ",", "")


def render(template: str, values: dict[str, Column | str | float]) -> Column:
    """Template -> ``concat`` expression. Column values are formatted by their
    spec; plain Python values are rendered at plan time."""
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name, spec = m.group(1), m.group(2) or ""
        v = values[name]
        if isinstance(v, Column):
            parts.append(_num(v, spec) if spec else v)
        else:
            parts.append(F.lit(format(v, spec) if spec else str(v)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def _feature_text(name: str, value: Column, score: Column, peer: Column) -> Column:
    return render(feature_template(name), {
        "col": name, "value": value, "score": score, "peer": peer,
        "pct": value * 100, "count": value.cast("bigint"),
    })


def flag_reason_expr(columns: Sequence[str], iqr_multiplier: float = 2.0,
                     suspicious_reversal_ratio: float = 5.0, high_balance_threshold: float = 100_000.0,
                     high_ros_score: float = 0.7) -> Column:
    """L1: plain-English reason for one partner row, as a Column.

    ``iqr_multiplier`` is accepted for signature parity; the triggered list
    already encodes it.
    """
    cols = set(columns)

    def get(name: str, default) -> Column:
        return F.col(name) if name in cols else F.lit(default)

    peer = F.col("PeerGroup") if "PeerGroup" in cols else (F.col("Segment") if "Segment" in cols else F.lit("peer group"))
    triggered = F.coalesce(get("iqr_triggered_cols", ""), F.lit(""))
    names = F.transform(F.split(triggered, ", "), lambda s: F.trim(s))

    parts = []
    for c in columns:
        if c.endswith("_iqr_score") and c[: -len("_iqr_score")] in cols:
            base = c[: -len("_iqr_score")]
            text = _feature_text(base, F.col(base), F.col(c), peer)
            parts.append(F.struct(F.array_position(names, F.lit(base)).alias("pos"), text.alias("text")))
    if parts:
        picked = F.filter(F.array(*parts), lambda s: (s["pos"] > 0) & s["text"].isNotNull())
        per_feature = F.array_join(F.transform(F.array_sort(picked), lambda s: s["text"]), REASON_SEPARATOR)
        per_feature = F.when(triggered != "", per_feature).otherwise(F.lit(""))
    else:
        per_feature = F.lit("")

    reversal = get("ReversalRatio", 0.0)
    ros = get("AvgROSScore", 0.0)
    balance = get("Balance", 0.0)
    rules = [
        F.when((reversal > F.lit(suspicious_reversal_ratio)) & ~triggered.contains("ReversalRatio"),
               render(RULE_REVERSAL, {"value": reversal, "limit": float(suspicious_reversal_ratio)})),
        F.when((ros > F.lit(high_ros_score)) & ~triggered.contains("AvgROSScore"),
               render(RULE_ROS, {"value": ros})),
        F.when(F.abs(balance) > F.lit(high_balance_threshold),
               render(RULE_BALANCE, {"value": balance, "limit": float(high_balance_threshold)})),
    ]
    base = F.concat_ws(REASON_SEPARATOR, F.when(per_feature != "", per_feature), *rules)
    if_flag = F.coalesce(get("isolation_forest_flag", False).cast("boolean"), F.lit(False))
    fallback = render(IF_ONLY, {"peer": peer, "risk": get("risk_score", 0.0)})
    return F.when((base == "") & if_flag, fallback).otherwise(base)


def is_flagged_expr(columns: Sequence[str]) -> Column:
    cols = set(columns)
    f_if = F.coalesce(F.col("isolation_forest_flag"), F.lit(False)) if "isolation_forest_flag" in cols else F.lit(False)
    f_iqr = F.coalesce(F.col("iqr_flag"), F.lit(False)) if "iqr_flag" in cols else F.lit(False)
    return f_if | f_iqr


def build_alert_column(df: DataFrame, iqr_multiplier: float = 2.0, suspicious_reversal_ratio: float = 5.0,
                       high_balance_threshold: float = 100_000.0, high_ros_score: float = 0.7) -> DataFrame:
    """L2: ``flag_reason`` on flagged rows (IF or IQR), ``''`` elsewhere."""
    reason = flag_reason_expr(df.columns, iqr_multiplier, suspicious_reversal_ratio,
                              high_balance_threshold, high_ros_score)
    return df.withColumn("flag_reason", F.when(is_flagged_expr(df.columns), reason).otherwise(F.lit("")))


# ------------------------------------------------------------------ W4
def confidence_tier(columns: Sequence[str]) -> Column:
    cols = set(columns)
    f_if = F.coalesce(F.col("isolation_forest_flag"), F.lit(False)) if "isolation_forest_flag" in cols else F.lit(False)
    f_iqr = F.coalesce(F.col("iqr_flag"), F.lit(False)) if "iqr_flag" in cols else F.lit(False)
    return F.when(f_if & f_iqr, 3).when(f_iqr, 2).when(f_if, 1).otherwise(0)


def deduplicate_within_run(df: DataFrame, partner_col: str = "BusinessPartner",
                           tie_col: str | None = None) -> DataFrame:
    """One row per partner: highest tier (both > IQR > IF), then highest
    ``risk_score`` (NULL/NaN last), then smallest ``tie_col``.

    ``min`` over a ranking struct is a decomposable aggregate: partial
    aggregation keeps one candidate per partner per task before the shuffle.
    """
    cols = df.columns
    risk = F.col("risk_score").cast("double") if "risk_score" in cols else F.lit(0.0)
    neg_risk = F.coalesce(-F.nanvl(risk, F.lit(None).cast("double")), F.lit(float("inf")))
    rank_fields = [(-confidence_tier(cols)).alias("t"), neg_risk.alias("r")]
    if tie_col:
        rank_fields.append(F.col(tie_col).alias("k"))
    row = F.struct(*[F.col(c) for c in cols]).alias("row")
    best = df.groupBy(partner_col).agg(F.min(F.struct(*rank_fields, row)).alias("_best"))
    return best.select(*[F.col("_best.row")[c].alias(c) for c in cols])


# ------------------------------------------------------------------ J4, S8, L3
def recent_partners(history: DataFrame, as_of: date, cooldown_days: int,
                    partner_col: str = "BusinessPartner") -> DataFrame:
    """Distinct partners alerted in [as_of - cooldown, as_of). On a history
    table partitioned by ``run_date`` the range becomes a partition filter."""
    start = as_of - timedelta(days=cooldown_days)
    rd = F.col("run_date").cast("date")
    return history.filter((rd >= F.lit(start)) & (rd < F.lit(as_of))).select(partner_col).distinct()


_RECENT = "_recently_alerted"


def mark_recent(new_alerts: DataFrame, history: DataFrame, as_of: date,
                partner_col: str = "BusinessPartner", cooldown_days: int = 30) -> DataFrame:
    """New alerts with a boolean: whether the partner had a recent alert."""
    recent = recent_partners(history, as_of, cooldown_days, partner_col).withColumn(_RECENT, F.lit(True))
    joined = new_alerts.join(recent, partner_col, "left")
    return joined.withColumn(_RECENT, F.coalesce(F.col(_RECENT), F.lit(False))).select(*new_alerts.columns, _RECENT)


def filter_recently_alerted(new_alerts: DataFrame, history: DataFrame, as_of: date,
                            partner_col: str = "BusinessPartner",
                            cooldown_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(fresh, suppressed) = new alerts without / with a recent alert."""
    marked = mark_recent(new_alerts, history, as_of, partner_col, cooldown_days)
    return marked.filter(~F.col(_RECENT)).drop(_RECENT), marked.filter(F.col(_RECENT)).drop(_RECENT)


def stamp_for_history(alerts_df: DataFrame, as_of: date,
                      save_cols: Sequence[str] = C.HISTORY_COLUMNS) -> DataFrame:
    """The rows S8 appends: saved columns present in the input + ``run_date``."""
    keep = [c for c in save_cols if c in alerts_df.columns]
    return alerts_df.select(*keep, F.lit(as_of).alias("run_date"))


def history_log(history: DataFrame, new_alerts: DataFrame, as_of: date,
                save_cols: Sequence[str] = C.HISTORY_COLUMNS) -> DataFrame:
    """S8 (logical part): the full log after appending ``new_alerts`` today."""
    return history.unionByName(stamp_for_history(new_alerts, as_of, save_cols), allowMissingColumns=True)


class DedupResult(NamedTuple):
    fresh: DataFrame
    suppressed: DataFrame
    history: DataFrame
    deduped: DataFrame
    marked: DataFrame


def run_full_deduplication(new_alerts: DataFrame, history: DataFrame, as_of: date,
                           cooldown_days: int = 30, partner_col: str = "BusinessPartner",
                           tie_col: str | None = None) -> DedupResult:
    """L3: W4 -> J4 -> S8 (logical). Writing the log is ``sources.files.write_history``."""
    deduped = deduplicate_within_run(new_alerts, partner_col, tie_col)
    marked = mark_recent(deduped, history, as_of, partner_col, cooldown_days)
    fresh = marked.filter(~F.col(_RECENT)).drop(_RECENT)
    suppressed = marked.filter(F.col(_RECENT)).drop(_RECENT)
    return DedupResult(fresh, suppressed, history_log(history, fresh, as_of), deduped, marked)


def alert_summary(result: DedupResult) -> DataFrame:
    """L3 counts: flagged this run (after dedup), fresh, suppressed (one row)."""
    recent = F.count_if(F.col(_RECENT))
    total = F.count(F.lit(1))
    return result.marked.agg(total.alias("total_flagged"), (total - recent).alias("fresh_alerts"),
                             recent.alias("suppressed_alerts"))


# ------------------------------------------------------------------ L4-L6
def watchlist(fresh: DataFrame, columns: Sequence[str] = C.WATCHLIST_COLUMNS,
              partner_col: str = "BusinessPartner") -> DataFrame:
    """L4: present watchlist columns, highest risk first (ties by partner)."""
    keep = [c for c in columns if c in fresh.columns]
    order = [F.desc_nulls_last("risk_score")] if "risk_score" in fresh.columns else []
    if partner_col in fresh.columns:
        order.append(F.asc(partner_col))
    return fresh.select(*keep).orderBy(*order)


def show_top(df: DataFrame, col: str, n: int = 12, partner_col: str = "BusinessPartner") -> DataFrame:
    """The n partners with the largest ``col`` (planned as TakeOrderedAndProject)."""
    disp = [c for c in (partner_col, "BusinessPartnerName", "Segment", col, "TotalTransactions", "TotalAmount")
            if c in df.columns]
    disp = list(dict.fromkeys(disp))
    return df.filter(F.col(col).isNotNull()).orderBy(F.desc(col), F.asc(partner_col)).limit(n).select(*disp)


def yes_no(c: str) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit(False)), F.lit("YES")).otherwise(F.lit("no"))


def top_watchlist(scored: DataFrame, n: int = 20, partner_col: str = "BusinessPartner") -> DataFrame:
    """The n highest-risk flagged partners, flags rendered YES/no."""
    flagged = scored.filter(is_flagged_expr(scored.columns))
    cols = [c for c in (partner_col, "BusinessPartnerName", "Segment", "TotalTransactions", "TotalAmount",
                        "MaxSingleAmount", "ReversalRatio", "Balance", "risk_score", "flag_reason")
            if c in scored.columns]
    top = flagged.orderBy(F.desc_nulls_last("risk_score"), F.asc(partner_col)).limit(n)
    return top.select(*cols, yes_no("isolation_forest_flag").alias("IF"), yes_no("iqr_flag").alias("IQR"))


def sample_reasons(scored: DataFrame, n: int = 10, partner_col: str = "BusinessPartner") -> DataFrame:
    """N flagged partners with a non-empty reason (partner order)."""
    rows = scored.filter(is_flagged_expr(scored.columns) & (F.col("flag_reason") != ""))
    cols = [c for c in (partner_col, "BusinessPartnerName", "Segment", "risk_score", "flag_reason") if c in scored.columns]
    return rows.orderBy(partner_col).limit(n).select(*cols)
