"""Peer-relative scores.

Each operator computes a small per-group statistics table with decomposable
aggregates or the distributed exact quantile of ``functions.stats`` and joins
it back; nothing ranks a whole group inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.functions import stats
from partnerwatch.functions.scalar import greatest_of, nan_to_null
from partnerwatch.operators.features import add_peer_group


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _group_cols(group_col: str | None) -> list[str]:
    return [group_col] if group_col else []


def add_peer_zscores(df: DataFrame, cols: Sequence[str] | None = None, segment_col: str = "PeerGroup",
                     group_bound: int | None = None) -> DataFrame:
    """``{col}_zscore`` = (x - group mean) / group sample std (0 -> 1).
    A group of one has no sample std, so its z-scores are NULL."""
    cols = list(C.ZSCORE_COLUMNS if cols is None else cols)
    out = add_peer_group(df, segment_col)
    present = _present(out, cols)
    if not present:
        return out
    moments = stats.group_moments(out, [segment_col], present, prefix="_z_")
    joined = stats.attach(out, moments, [segment_col], group_bound)
    z = {}
    for c in present:
        sd = F.col(f"_z_{c}__std")
        sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        z[f"{c}_zscore"] = (nan_to_null(c) - F.col(f"_z_{c}__mean")) / sd
    return joined.withColumns(z).select(*out.columns, *z.keys())


def iqr_scores(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None = "Segment",
               group_bound: int | None = None) -> tuple[DataFrame, list[str]]:
    """``{col}_iqr_score`` = (x - Q3) / (Q3 - Q1) within the group, linear
    quantiles; a zero IQR scores every row of the group 0."""
    present = _present(df, feature_cols)
    if not present:
        return df, []
    groups = _group_cols(segment_col)
    q = stats.group_quantiles_wide(df, groups, present, (0.25, 0.75), ("q1", "q3"), group_bound=group_bound)
    q = q.select(*groups, *[F.col(f"{c}__{n}").alias(f"_iqr_{c}__{n}") for c in present for n in ("q1", "q3")])
    joined = stats.attach(df, q, groups, group_bound)
    scores = {}
    for c in present:
        q1, q3 = F.col(f"_iqr_{c}__q1"), F.col(f"_iqr_{c}__q3")
        iqr = q3 - q1
        scores[f"{c}_iqr_score"] = F.when(iqr == 0, F.lit(0.0)).otherwise((nan_to_null(c) - q3) / iqr)
    return joined.withColumns(scores).select(*df.columns, *scores.keys()), present


def score_features_by_segment(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None = "Segment",
                              iqr_multiplier: float = 2.0, group_bound: int | None = None) -> DataFrame:
    """W2 + W3: per-feature IQR scores, ``iqr_max_score``, ``iqr_flag`` (any score
    above the multiplier) and ``iqr_triggered_cols`` (names, feature order)."""
    scored, present = iqr_scores(df, feature_cols, segment_col, group_bound)
    if not present:
        return df.withColumns({
            "iqr_flag": F.lit(False),
            "iqr_max_score": F.lit(0.0),
            "iqr_triggered_cols": F.lit(""),
        })
    m = F.lit(float(iqr_multiplier))
    score_cols = [F.col(f"{c}_iqr_score") for c in present]
    max_score = greatest_of(score_cols)
    triggered = F.concat_ws(", ", *[F.when(F.col(f"{c}_iqr_score") > m, F.lit(c)) for c in present])
    return scored.withColumns({
        "iqr_max_score": max_score,
        "iqr_flag": F.coalesce(max_score > m, F.lit(False)),
        "iqr_triggered_cols": triggered,
    })


def winsorize(df: DataFrame, cols: Sequence[str], upper_quantile: float = 0.99,
              group_col: str | None = None, group_bound: int | None = None) -> DataFrame:
    """Clip each column at its (group's) upper quantile; other columns kept."""
    present = _present(df, cols)
    groups = _group_cols(group_col)
    q = stats.group_quantiles_wide(df, groups, present, (upper_quantile,), ("cap",), group_bound=group_bound)
    q = q.select(*groups, *[F.col(f"{c}__cap").alias(f"_w_{c}") for c in present])
    joined = stats.attach(df, q, groups, group_bound)
    clipped = {c: F.least(F.col(c).cast("double"), F.col(f"_w_{c}")) for c in present}
    return joined.withColumns(clipped).select(*df.columns)


def clip_range(df: DataFrame, cols: Sequence[str], lower: float, upper: float) -> DataFrame:
    """W5 (fixed form): clip to [lower, upper]."""
    return df.withColumns({
        c: F.least(F.greatest(F.col(c).cast("double"), F.lit(float(lower))), F.lit(float(upper)))
        for c in _present(df, cols)
    })


def standard_scale(df: DataFrame, cols: Sequence[str], group_col: str | None = None,
                   group_bound: int | None = None, suffix: str = "_scaled") -> DataFrame:
    """M1: (x - mean) / population std per group (or global), std 0 -> 1, NULL -> 0
    first (the model input convention)."""
    present = _present(df, cols)
    filled = df.fillna(0, subset=present)
    groups = _group_cols(group_col)
    moments = stats.group_moments(filled, groups, present, prefix="_s_")
    joined = stats.attach(filled, moments, groups, group_bound)
    scaled = {}
    for c in present:
        sd = F.col(f"_s_{c}__pstd")
        sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        scaled[f"{c}{suffix}"] = (F.col(c) - F.col(f"_s_{c}__mean")) / sd
    return joined.withColumns(scaled).select(*df.columns, *scaled.keys())
