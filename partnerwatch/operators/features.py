"""Transaction signals, cancellation netting and the partner rollup
(P10-P16, J1-J3, A1, A2).

Row signals are pure expressions. Netting needs a group property of
(partner, amount): it is found with a pre-aggregated key table and joined back
to the AC/ZC rows only; the rollup is one ``groupBy`` with conditional
aggregates, so netted counts need no second join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.functions.scalar import (
    greatest_of,
    indicator,
    money_sum,
    is_round,
    label_lookup,
    ros_kernel,
)


# ----------------------------------------------------------------- P10-P15
def add_reversal_flags(df: DataFrame, doc_type_col: str = "CADocumentType",
                       ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE) -> DataFrame:
    """P10: ``ACDocCount`` / ``ZCDocCount`` 0/1 indicators."""
    t = F.col(doc_type_col)
    return df.withColumns({"ACDocCount": indicator(t == ac_type), "ZCDocCount": indicator(t == zc_type)})


def add_value_flags(df: DataFrame, amount_col: str = "Amount", high_threshold: float = 10_000.0,
                    extreme_threshold: float = 100_000.0) -> DataFrame:
    """Strict ``>`` high / extreme value indicators."""
    x = F.col(amount_col)
    return df.withColumns({
        "IsHighValue": indicator(x > F.lit(high_threshold)),
        "IsExtremeValue": indicator(x > F.lit(extreme_threshold)),
    })


def add_ros_score(df: DataFrame, amount_col: str = "Amount",
                  authority_limits: Sequence[float] = C.AUTHORITY_LIMITS,
                  bandwidth: float = C.ROS_BANDWIDTH) -> DataFrame:
    """Gaussian closeness to the nearest authority limit, in [0, 1]."""
    return df.withColumn("ROSScore", ros_kernel(amount_col, authority_limits, bandwidth))


def add_round_flags(df: DataFrame, amount_col: str = "Amount",
                    round_thresholds: Sequence[int] = C.ROUND_THRESHOLDS) -> DataFrame:
    """``IsRound{t}`` for each threshold (positive multiples) and ``IsRoundAny``."""
    flags = {f"IsRound{t}": is_round(amount_col, t) for t in round_thresholds}
    out = df.withColumns(flags)
    return out.withColumn("IsRoundAny", greatest_of([F.col(c) for c in flags]))


def add_segment_label(df: DataFrame, segment_col: str = "CAAccountDeterminationCode",
                      segment_labels: dict[str, str] | None = None) -> DataFrame:
    """``Segment`` from the account-determination code; unknown -> ``Unknown``."""
    labels = C.SEGMENT_LABELS if segment_labels is None else segment_labels
    return df.withColumn("Segment", label_lookup(segment_col, labels, C.SEGMENT_DEFAULT))


def add_transaction_type_label(df: DataFrame, main_txn_col: str = "CAMainTransaction",
                               labels: dict[str, str] | None = None) -> DataFrame:
    """``TransactionType`` from the main-transaction code; unknown -> ``Other``."""
    lab = C.TRANSACTION_TYPE_LABELS if labels is None else labels
    return df.withColumn("TransactionType", label_lookup(main_txn_col, lab, C.TRANSACTION_TYPE_DEFAULT))


def add_transaction_signals(df: DataFrame, by: C.Signals = C.DEFAULTS.signals) -> DataFrame:
    """P10-P15 in one projection."""
    out = add_reversal_flags(df)
    out = add_value_flags(out, "Amount", by.high, by.extreme)
    out = add_ros_score(out, "Amount", by.limits, by.bandwidth)
    out = add_round_flags(out, "Amount", by.round_to)
    out = add_segment_label(out)
    return add_transaction_type_label(out)


def add_peer_group(df: DataFrame, out_col: str = "PeerGroup", segment_col: str = "Segment",
                   type_col: str = "TransactionType") -> DataFrame:
    """``Segment_TransactionType``; falls back to Segment, then ``ALL``."""
    if out_col in df.columns:
        return df
    if segment_col in df.columns and type_col in df.columns:
        key = F.concat(F.col(segment_col), F.lit("_"), F.col(type_col))
    elif segment_col in df.columns:
        key = F.col(segment_col)
    else:
        key = F.lit("ALL")
    return df.withColumn(out_col, key)


# ----------------------------------------------------------------- J1, J2
_NET_AMT = "_net_amount"


def net_cancellation_pairs(df: DataFrame, partner_col: str = "BusinessPartner",
                           amount_col: str = "Amount", doc_type_col: str = "CADocumentType",
                           ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE) -> DataFrame:
    """``IsNetted`` = 1 on every AC and ZC row whose (partner, amount rounded
    half-even to cents) key holds at least one AC and one ZC row (set semantics).

    Only AC/ZC rows are shuffled. The key table is pre-aggregated map side and
    has one row per key, so the join cannot multiply rows; a hot key on the row
    side is split by AQE's skew-join handling, and AQE broadcasts the key table
    at run time when it is small.
    """
    t = F.col(doc_type_col)
    is_pair_type = t.isin(ac_type, zc_type)
    key_amount = F.bround(F.col(amount_col), 2)

    candidates = df.filter(is_pair_type).withColumn(_NET_AMT, key_amount)
    others = df.filter(~is_pair_type | t.isNull()).withColumn("IsNetted", F.lit(0))

    keys = (
        candidates.groupBy(partner_col, _NET_AMT)
        .agg(F.max(t == ac_type).alias("_has_ac"), F.max(t == zc_type).alias("_has_zc"))
        .filter(F.col("_has_ac") & F.col("_has_zc"))
        .select(partner_col, _NET_AMT, F.lit(1).alias("_paired"))
    )
    matched = (
        candidates.join(keys, [partner_col, _NET_AMT], "left")
        .withColumn("IsNetted", F.coalesce(F.col("_paired"), F.lit(0)))
        .drop("_paired", _NET_AMT)
    )
    return matched.unionByName(others.select(*matched.columns))


def net_within_partners(df: DataFrame, partner_col: str = "BusinessPartner",
                        amount_col: str = "Amount", doc_type_col: str = "CADocumentType",
                        ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE) -> DataFrame:
    """J1 as ``net_cancellation_pairs`` decides it, by a window instead of a join: rows
    that lie by partner already are not shuffled again. For partners of at most
    ``BUSY_ROWS`` rows."""
    t = F.col(doc_type_col)
    key = F.when(t.isin(ac_type, zc_type), F.bround(F.col(amount_col), 2))
    pair = Window.partitionBy(partner_col, _NET_AMT)
    both = F.max(t == ac_type).over(pair) & F.max(t == zc_type).over(pair)
    paired = F.col(partner_col).isNotNull() & F.col(_NET_AMT).isNotNull() & both
    return df.withColumn(_NET_AMT, key).withColumn("IsNetted", indicator(paired)).drop(_NET_AMT)


#: A partner with more rows is busy: its rows are spread over tasks. There are at most
#: rows / BUSY_ROWS such partners, so their list is broadcast.
BUSY_ROWS = 200_000


def split_busy(by_partner: DataFrame, plain: DataFrame, partner_col: str = "BusinessPartner",
               most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of partners with at most ``most`` rows, from ``by_partner``; rows of the
    others, from ``plain``), both scans of one table (``session.cut_by_key``)."""
    most = BUSY_ROWS if most is None else most
    rows = plain.filter(F.col(partner_col).isNotNull()).groupBy(partner_col).agg(F.count(F.lit(1)).alias("_rows"))
    busy = F.broadcast(rows.filter(F.col("_rows") > most).select(partner_col))
    return by_partner.join(busy, partner_col, "left_anti"), plain.join(busy, partner_col, "left_semi")


def netting_summary(netted: DataFrame, partner_col: str = "BusinessPartner") -> DataFrame:
    """Rows netted out and distinct partners affected (one row)."""
    flag = F.col("IsNetted") == 1
    return netted.agg(
        F.coalesce(F.sum(F.col("IsNetted").cast("bigint")), F.lit(0)).cast("bigint").alias("netted_rows"),
        F.count_distinct(F.when(flag, F.col(partner_col))).alias("netted_partners"),
    )


# ----------------------------------------------------------------- A1, A2
def _first_by(order: Column, value: str, cond: Column) -> Column:
    """Value of the first row (by ``order``) with a non-NULL ``value`` among ``cond`` rows."""
    v = F.col(value)
    return F.min(F.when(cond & v.isNotNull(), F.struct(order.alias("o"), v.alias("v"))))["v"]


DISTINCT_COUNTS = (
    ("CADocumentType", "UniqueDocTypes"),
    ("CAMainTransaction", "UniqueMainTransactions"),
    ("ContractAccount", "UniqueContracts"),
)
FIRST_VALUES = ("BusinessPartnerName", "Segment", "TransactionType")


def distinct_counts(df: DataFrame, key: str, cols_out: Sequence[tuple[str, str]], cond: Column) -> DataFrame:
    """Exact distinct counts of several columns per key in one two-level hash
    aggregation: (key, column, value) triples are de-duplicated map side first,
    then counted per key. Numeric buffers only, so both levels stay in
    codegen'd ``HashAggregate``; a key with very many rows is folded to its
    distinct values before the shuffle."""
    triples = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v"))
                        for i, (c, _) in enumerate(cols_out)])
    distinct = (df.filter(cond).select(key, F.inline(triples))
                .filter(F.col("_v").isNotNull()).distinct())
    return distinct.groupBy(key).agg(*[F.count_if(F.col("_i") == i).alias(out)
                                       for i, (_, out) in enumerate(cols_out)])


def aggregate_to_partner_level(df: DataFrame, use_netted: bool = True,
                               partner_col: str = "BusinessPartner",
                               order_col: str = "CADocumentNumber", together: bool = False) -> DataFrame:
    """A1: one row per partner over its non-netted rows.

    Three aggregations by partner, joined on the partner key (all three are
    hash-partitioned by it, so the joins add no exchange):

    * numeric: counts, exact money sum, std, max, sums of flags and
      ``NettedPairsCount`` (conditional aggregates: no join for the netted
      counts); fixed-width buffers, so it is a codegen'd ``HashAggregate`` with
      partial aggregation;
    * first values: the first non-NULL value in ``order_col`` order
      (deterministic, Q9) as ``min(struct(order, value))`` on a narrow projection;
    * exact distinct counts (``distinct_counts``).

    With ``together`` all three are one aggregation, which holds the distinct values
    of a partner: right for rows that lie by partner, ``BUSY_ROWS`` a partner at most.

    Partners whose rows are all netted are dropped (Q8). Columns the input
    lacks are skipped; NULL numeric results become 0.
    """
    have = set(df.columns)
    if use_netted and "IsNetted" in have:
        clean = F.col("IsNetted") == 0
        netted_count = F.count_if(F.col("IsNetted") == 1).alias("NettedPairsCount")
    else:
        clean = F.lit(True)
        netted_count = F.lit(0).cast("bigint").alias("NettedPairsCount")

    def on_clean(c: str) -> Column:
        return F.when(clean, F.col(c))

    amt = on_clean("Amount")
    aggs: list[Column] = [
        F.count(amt).alias("TotalTransactions"),
        money_sum(amt).alias("TotalAmount"),
        F.stddev_samp(amt).alias("StdAmount"),
        F.max(amt).alias("MaxSingleAmount"),
    ]
    optional = [
        ("NumberOfItems", F.sum, "TotalItems"),
        ("ACDocCount", F.sum, "ACDocCount"),
        ("ZCDocCount", F.sum, "ZCDocCount"),
        ("IsHighValue", F.sum, "HighValueCount"),
        ("IsExtremeValue", F.sum, "ExtremeValueCount"),
        ("Balance", F.max, "Balance"),
        ("TotalDebit", F.max, "TotalDebit"),
        ("TotalCredit", F.max, "TotalCredit"),
        ("DaysOverdue", F.avg, "AvgDaysOverdue"),
        ("DaysOverdue", F.max, "MaxDaysOverdue"),
        ("ROSScore", F.avg, "AvgROSScore"),
        ("ROSScore", F.max, "MaxROSScore"),
        ("IsRoundAny", F.sum, "RoundTransactionCount"),
    ]
    aggs += [fn(on_clean(src)).alias(out) for src, fn, out in optional if src in have]
    aggs.append(netted_count)
    first_cols = [c for c in FIRST_VALUES if c in have]
    wanted = [(c, out) for c, out in DISTINCT_COUNTS if c in have]
    order = F.col(order_col) if order_col in have else F.lit(None).cast("string")
    if together:
        aggs += [_first_by(order, c, clean).alias(c) for c in first_cols]
        aggs += [F.size(F.collect_set(on_clean(c).cast("string"))).cast("bigint").alias(out) for c, out in wanted]
    rolled = df.groupBy(partner_col).agg(*aggs).filter(F.col("TotalTransactions") > 0)

    if first_cols and not together:
        firsts = df.select(partner_col, order.alias("_o"), clean.alias("_clean"), *first_cols).groupBy(partner_col).agg(
            *[_first_by(F.col("_o"), c, F.col("_clean")).alias(c) for c in first_cols])
        rolled = rolled.join(firsts, partner_col, "left")
    if wanted and not together:
        rolled = rolled.join(distinct_counts(df, partner_col, wanted, clean), partner_col, "left")

    rolled = rolled.withColumn("AvgAmount", F.col("TotalAmount") / F.col("TotalTransactions"))
    lead = [partner_col, *first_cols, "TotalTransactions", "TotalAmount", "AvgAmount", "StdAmount",
            "MaxSingleAmount"] + [c for c in ("TotalItems",) if c in rolled.columns] + [out for _, out in wanted]
    rolled = rolled.select(*lead, *[c for c in rolled.columns if c not in lead])
    numeric = [f.name for f in rolled.schema.fields
               if f.name != partner_col and f.dataType.typeName() in ("long", "integer", "double")]
    rolled = rolled.fillna(0, subset=numeric)

    derived: dict[str, Column] = {}
    if "ZCDocCount" in rolled.columns and "ACDocCount" in rolled.columns:
        derived["ReversalRatio"] = F.col("ZCDocCount") / (F.col("ACDocCount") + 1)
    derived["AmountVolatility"] = F.col("StdAmount") / (F.col("AvgAmount") + 1)
    if "RoundTransactionCount" in rolled.columns:
        derived["RoundTransactionRate"] = F.col("RoundTransactionCount") / (F.col("TotalTransactions") + 1)
    out = rolled.withColumns(derived)
    # NettedPairsCount last, as the reference merges it on at the end
    cols = [c for c in out.columns if c != "NettedPairsCount"] + ["NettedPairsCount"]
    return out.select(*cols)


SLIM_ROLLUP_COLUMNS = (
    "BusinessPartner", "BusinessPartnerName", "Segment", "TotalTransactions", "TotalAmount",
    "AvgAmount", "StdAmount", "MaxSingleAmount", "ACDocCount", "ZCDocCount", "HighValueCount",
    "ExtremeValueCount", "Balance", "TotalDebit", "ReversalRatio", "AmountVolatility",
)


def partner_rollup_raw(df: DataFrame, partner_col: str = "BusinessPartner",
                       order_col: str = "CADocumentNumber") -> DataFrame:
    """A2: the exploration rollup: all rows (no netting), a column subset."""
    slim_src = [c for c in df.columns if c in {
        partner_col, order_col, "BusinessPartnerName", "Segment", "Amount", "ACDocCount", "ZCDocCount",
        "IsHighValue", "IsExtremeValue", "Balance", "TotalDebit"}]
    rolled = aggregate_to_partner_level(df.select(*slim_src), use_netted=False,
                                        partner_col=partner_col, order_col=order_col)
    return rolled.select(*[c for c in SLIM_ROLLUP_COLUMNS if c in rolled.columns])
