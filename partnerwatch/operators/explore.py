"""Exploration tables (A3-A16, H1, H2): the numbers behind the exploration
charts and summaries, as distributed aggregates.

Quantiles use the exact distributed quantile of ``functions.stats``; one-row
results (totals, global min/max) are attached through a bounded broadcast;
pandas' ``round`` (half-even on the scaled double) is ``bround(x * 10^d) / 10^d``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerwatch.functions import stats
from partnerwatch.functions.scalar import money_sum, nan_to_null

EDA_FEATURES = ("TotalTransactions", "TotalAmount", "AvgAmount", "MaxSingleAmount", "ReversalRatio",
                "AmountVolatility", "HighValueCount", "ExtremeValueCount")
EDA_CORR_FEATURES = ("TotalTransactions", "TotalAmount", "AvgAmount", "MaxSingleAmount", "ReversalRatio",
                     "AmountVolatility", "Balance", "TotalDebit", "HighValueCount", "ExtremeValueCount")


def pandas_round(c: Column, decimals: int) -> Column:
    """numpy/pandas ``round``: half-even on x * 10^d."""
    scale = float(10 ** decimals)
    return F.bround(c * F.lit(scale)) / F.lit(scale)


def segment_overview(tx: DataFrame, segment_col: str = "Segment", partner_col: str = "BusinessPartner") -> DataFrame:
    """A3: transactions, total, average, distinct partners and share per segment."""
    per = tx.groupBy(segment_col).agg(
        F.count("Amount").alias("Transactions"),
        money_sum("Amount").alias("TotalAmount"),
        F.count_distinct(partner_col).alias("UniquePartners"),
    ).withColumn("AvgAmount", F.col("TotalAmount") / F.col("Transactions"))
    per = per.select(segment_col, "Transactions", "TotalAmount", "AvgAmount", "UniquePartners")
    total = per.agg(F.sum("Transactions").alias("_all"))
    with_total = stats.attach(per, total, [])
    return with_total.withColumn(
        "PctTransactions", pandas_round(F.col("Transactions") / F.col("_all") * 100, 1)).drop("_all")


def doc_type_counts(tx: DataFrame, doc_type_col: str = "CADocumentType") -> DataFrame:
    """A4: value counts of the document type, most frequent first."""
    return (tx.groupBy(F.col(doc_type_col).alias("DocumentType"))
            .agg(F.count(F.lit(1)).alias("Count"))
            .filter(F.col("DocumentType").isNotNull())
            .orderBy(F.desc("Count"), "DocumentType"))


def global_reversal_ratio(tx: DataFrame, doc_type_col: str = "CADocumentType",
                          ac_type: str = "AC", zc_type: str = "ZC") -> DataFrame:
    """A5: AC and ZC totals and ZC / (AC + 1) over all rows."""
    t = F.col(doc_type_col)
    agg = tx.agg(F.count_if(t == ac_type).alias("ac_total"), F.count_if(t == zc_type).alias("zc_total"))
    return agg.withColumn("global_ratio", F.col("zc_total") / (F.col("ac_total") + 1))


def monthly_series(tx: DataFrame, date_col: str = "NetDueDate") -> DataFrame:
    """Count and amount per calendar month of the due date, in month order."""
    month = F.date_format(F.col(date_col), "yyyy-MM")
    return (tx.filter(F.col(date_col).isNotNull())
            .groupBy(month.alias("month"))
            .agg(F.count("Amount").alias("transaction_count"), money_sum("Amount").alias("total_amount"))
            .orderBy("month"))


def amount_summary(tx: DataFrame, amount_col: str = "Amount") -> DataFrame:
    """Largest, median, 99th percentile, counts above 10k and 100k."""
    q = stats.column_quantiles(tx, amount_col, (0.5, 0.99), ("median", "p99"))
    basic = tx.agg(
        F.max(amount_col).alias("largest"),
        F.count_if(F.col(amount_col) > 10_000).alias("over_10k"),
        F.count_if(F.col(amount_col) > 100_000).alias("over_100k"),
    )
    return stats.attach(basic, q, [])


def data_profile(df: DataFrame, partner_col: str = "BusinessPartner", date_col: str = "NetDueDate") -> DataFrame:
    """Rows, columns, distinct partners, date range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.count_distinct(partner_col).alias("partners"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    )


def describe_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: mean, sample std, min, median, max per feature (exact median)."""
    present = [c for c in cols if c in df.columns]
    long = stats.to_long(df, [], present)
    basic = long.groupBy(F.col("_feature").alias("feature")).agg(
        F.avg("_value").alias("mean"), F.stddev_samp("_value").alias("std"),
        F.min("_value").alias("min"), F.max("_value").alias("max"))
    med = stats.group_quantiles(df, [], present, (0.5,)).select(F.col("_feature").alias("feature"),
                                                                  F.col("q0").alias("p50"))
    return basic.join(med, "feature").select("feature", "mean", "std", "min", "p50", "max")


def feature_skew(df: DataFrame, cols: Sequence[str], label_above: float = 5.0) -> DataFrame:
    """Bias-corrected sample skewness (pandas ``skew``) and a strong-skew label."""
    present = [c for c in cols if c in df.columns]
    long = stats.to_long(df, [], present)
    g = long.groupBy(F.col("_feature").alias("feature")).agg(
        F.skewness("_value").alias("_g1"), F.count("_value").alias("_n"))
    n = F.col("_n").cast("double")
    adj = F.when(F.col("_n") >= 3, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return g.select("feature", adj.alias("skew"),
                    F.coalesce(F.abs(adj) > F.lit(label_above), F.lit(False)).alias("highly_skewed"))


def feature_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair i < j (long form), from mean-centred sums.
    A constant column gives NULL instead of an ANSI divide-by-zero."""
    present = [c for c in cols if c in df.columns]
    vals = {c: nan_to_null(c) for c in present}
    means = df.agg(*[F.avg(v).alias(f"_m_{c}") for c, v in vals.items()])
    centred = stats.attach(df.select(*[v.alias(c) for c, v in vals.items()]), means, [])
    d = {c: F.col(c) - F.col(f"_m_{c}") for c in present}
    pairs = [(a, b) for i, a in enumerate(present) for b in present[i + 1:]]
    sums = [F.sum(d[a] * d[b]).alias(f"_s_{a}__{b}") for a, b in pairs]
    sums += [F.sum(d[c] * d[c]).alias(f"_q_{c}") for c in present]
    s = centred.agg(*sums)
    rows = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.try_divide(F.col(f"_s_{a}__{b}"), F.sqrt(F.col(f"_q_{a}") * F.col(f"_q_{b}"))).alias("r"))
        for a, b in pairs])
    return s.select(F.inline(rows))


def correlated_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """Pairs with |r| above the threshold."""
    return feature_correlation(df, cols).filter(F.abs(F.col("r")) > F.lit(threshold))


def flag_breakdown(df: DataFrame, flag_col: str, group_col: str = "Segment", partner_col: str = "BusinessPartner",
                   flagged_name: str = "Flagged") -> DataFrame:
    """Partners, flagged partners and percentage per group."""
    agg = df.groupBy(group_col).agg(F.count(partner_col).alias("Partners"),
                                    F.count_if(F.col(flag_col)).alias(flagged_name))
    return agg.withColumn("PctFlagged", pandas_round(F.col(flagged_name) / F.col("Partners") * 100, 1))


def detection_overlap(df: DataFrame, if_col: str = "isolation_forest_flag", iqr_col: str = "iqr_flag") -> DataFrame:
    """Both / IF only / IQR only / neither."""
    a, b = F.coalesce(F.col(if_col), F.lit(False)), F.coalesce(F.col(iqr_col), F.lit(False))
    return df.agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("if_only"),
                  F.count_if(~a & b).alias("iqr_only"), F.count_if(~a & ~b).alias("neither"))


def eda_summary(tx: DataFrame, partners: DataFrame, doc_type_col: str = "CADocumentType") -> DataFrame:
    """The headline numbers of the exploration summary (one row)."""
    p99 = stats.column_quantiles(partners, "TotalTransactions", (0.99,), ("_p99",))
    p = stats.attach(partners, p99, []).agg(
        F.count(F.lit(1)).alias("partners"),
        F.count_if(F.col("ReversalRatio") > 5).alias("reversal_over_5x"),
        F.count_if(F.col("MaxSingleAmount") > 100_000).alias("max_amount_over_100k"),
        F.count_if(F.col("TotalTransactions") > F.col("_p99")).alias("top_1pct_volume"),
        F.max("ReversalRatio").alias("max_reversal_ratio"),
    )
    t = F.col(doc_type_col)
    med = stats.column_quantiles(tx, "Amount", (0.5,), ("median_amount",))
    x = tx.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.max("Amount").alias("largest_amount"),
        F.count_if(F.col("Amount") > 10_000).alias("over_10k"),
        F.count_if(F.col("Amount") > 100_000).alias("over_100k"),
        (F.count_if(t == "ZC") / (F.count_if(t == "AC") + 1)).alias("global_zc_ac_ratio"),
    )
    return stats.attach(stats.attach(x, med, []), p, [])


def histogram(df: DataFrame, col: str, bins: int = 100, upper_exclusive: float | None = None) -> DataFrame:
    """H1: equal-width histogram over [min, max] (last bin closed); optional
    ``col < upper_exclusive`` pre-filter. Non-empty bins only."""
    rows = df.filter(F.col(col).isNotNull())
    if upper_exclusive is not None:
        rows = rows.filter(F.col(col) < F.lit(upper_exclusive))
    rng = rows.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = stats.attach(rows.select(col), rng, [])
    width = F.col("_hi") - F.col("_lo")
    k = F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) * (k / width)), F.lit(bins - 1))).cast("int")
    out = j.groupBy(idx.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    step = (F.col("_hi") - F.col("_lo")) / k
    return out.select("bin", (F.col("_lo") + F.col("bin") * step).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * step).alias("bin_end"), "count")


REACH = 8.6  # bandwidths: exp(-0.5 * 8.6 ** 2) is below 1e-16


def segment_density(df: DataFrame, col: str, group_col: str = "Segment", clip_quantile: float = 0.95,
                    grid_points: int = 1000, min_rows: int = 5, group_bound: int | None = None) -> DataFrame:
    """H2: Gaussian KDE per group of ``col`` clipped at the group's quantile,
    Scott's bandwidth (n^-1/5 x sample std), evaluated on ``grid_points`` points
    spanning [min - range/2, max + range/2]. Groups under ``min_rows`` are skipped;
    the density of a group whose values are all equal is NULL.

    Equal values of a group are folded first; each distinct value adds its
    kernel, times its count, to the grid points within ``REACH`` bandwidths, beyond
    which a kernel is below 1e-16 of its height: a generator feeding a partial
    aggregation, whose memory is groups x grid points; no row pairs are formed.
    Points that no kernel reaches have density 0.
    """
    cap = stats.column_quantiles(df, col, (clip_quantile,), ("_cap",), group_cols=[group_col], group_bound=group_bound)
    clipped = stats.attach(df.select(group_col, col), cap, [group_col], group_bound).select(
        group_col, F.least(nan_to_null(col), F.col("_cap")).alias("_x")).filter(F.col("_x").isNotNull())
    g = clipped.groupBy(group_col).agg(
        F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_sd"), F.min("_x").alias("_min"),
        F.max("_x").alias("_max"))
    g = g.filter(F.col("_n") >= min_rows)
    n = F.col("_n").cast("double")
    spread = F.when(F.col("_sd") > 0, F.col("_sd"))  # NULL, and so the density, where all values are equal
    g = g.select(group_col, "_n", (spread * F.pow(n, F.lit(-0.2))).alias("_bw"),
                 (F.col("_min") - (F.col("_max") - F.col("_min")) * 0.5).alias("_g0"),
                 ((F.col("_max") - F.col("_min")) * 2 / F.lit(float(grid_points - 1))).alias("_gstep"))
    folded = clipped.groupBy(group_col, "_x").agg(F.count(F.lit(1)).alias("_w"))
    small = group_bound is not None and group_bound <= stats.BROADCAST_GROUP_LIMIT
    j = folded.join(F.broadcast(g) if small else g, group_col)
    step = F.when(F.col("_gstep") > 0, F.col("_gstep"))
    place = lambda x: (x - F.col("_g0")) / step
    last = F.lit(grid_points - 1)
    low = F.greatest(F.lit(0), F.floor(place(F.col("_x") - F.lit(REACH) * F.col("_bw"))).cast("int"))
    high = F.least(last, F.ceil(place(F.col("_x") + F.lit(REACH) * F.col("_bw"))).cast("int"))
    near = F.when(F.col("_bw").isNotNull() & step.isNotNull() & (low <= high), F.sequence(low, high))
    pts = j.select(group_col, "_x", "_w", "_bw", "_g0", "_gstep", F.explode(near).alias("point"))
    kern = F.exp(F.lit(-0.5) * F.pow(((F.col("_g0") + F.col("point") * F.col("_gstep")) - F.col("_x"))
                                     / F.col("_bw"), 2))
    sums = pts.groupBy(group_col, "point").agg(F.sum(F.col("_w") * kern).alias("_s"))
    grid = g.withColumn("point", F.explode(F.sequence(F.lit(0), last)))
    named = sums.select(F.col(group_col).alias("_of"), F.col("point").alias("_at"), "_s")
    dens = grid.join(named, F.col(group_col).eqNullSafe(F.col("_of")) & (F.col("point") == F.col("_at")), "left")
    norm = F.col("_n").cast("double") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))
    return dens.select(group_col, "point", (F.col("_g0") + F.col("point") * F.col("_gstep")).alias("x"),
                       (F.coalesce("_s", F.lit(0.0)) / norm).alias("density"))


# ------------------------------------------------------------------ X4 in one pass
def one_pass(tx: DataFrame, segment_col: str = "Segment", doc_type_col: str = "CADocumentType",
             date_col: str = "NetDueDate", partner_col: str = "BusinessPartner") -> DataFrame:
    """A3-A6, A8, A9 and the range of H1 over one scan: tagged rows (``part``: segment,
    doc_type, month or all; ``key``) of the measures those tables are made of.

    The ledger is folded once to (segment, document type, month, partner), map side
    first; the grouping sets, and the distinct partners, are taken of that table."""
    month = F.date_format(F.col(date_col), "yyyy-MM")
    amount = F.col("Amount")
    base = tx.select(F.col(segment_col).alias("_segment"), F.col(doc_type_col).alias("_doc_type"), month.alias("_month"),
                     F.col(partner_col).alias("_partner"), amount.alias("_amount"), F.col(date_col).alias("_date"))
    folded = base.groupBy("_segment", "_doc_type", "_month", "_partner").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("_amount").alias("_n"),
        F.sum(F.col("_amount").cast("decimal(38,6)")).alias("_total"), F.max("_amount").alias("_hi"), F.min("_amount").alias("_lo"),
        F.count_if(F.col("_amount") > 10_000).alias("_10k"), F.count_if(F.col("_amount") > 100_000).alias("_100k"),
        F.min("_date").alias("_first"), F.max("_date").alias("_last"))
    keys = [("segment", "_segment"), ("doc_type", "_doc_type"), ("month", "_month"), ("all", None)]
    tagged = folded.withColumn("_tag", F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), (F.col(c) if c else F.lit(None).cast("string")).alias("key")) for p, c in keys])))
    # partners first: a distinct count is then the number of their rows
    by_partner = tagged.groupBy("_tag.part", "_tag.key", "_partner").agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_n", "_total", "_10k", "_100k")],
        *[F.max(c).alias(c) for c in ("_hi", "_last")], *[F.min(c).alias(c) for c in ("_lo", "_first")])
    return by_partner.groupBy("part", "key").agg(
        F.sum("_rows").alias("rows"), F.sum("_n").alias("transactions"), F.sum("_total").cast("double").alias("total_amount"),
        F.max("_hi").alias("largest"), F.min("_lo").alias("smallest"), F.sum("_10k").alias("over_10k"), F.sum("_100k").alias("over_100k"),
        F.count("_partner").alias("partners"), F.min("_first").alias("first_date"), F.max("_last").alias("last_date"))
