"""Netting and partner rollup in one scan (J1, J2, J3, A1 together).

Rows are folded to ledger groups before anything is decided: one group per
(partner, netting key, the columns that are counted or named), with mergeable
states. The netting key is the amount rounded half-even to cents for credit and
reversal rows, NULL for all others. A key is netted where its groups hold both
document types; what is left is merged to partners.

Plan: the ledger is scanned once. Its rows are combined map side; the groups are
shuffled by key, once more by (partner, netting key) for the decision, and, again
combined map side, by partner and by (partner, counted value). Neither a row join nor a union is needed, no row
carries its flag back, and a partner or amount that holds a third of the rows is
folded where the rows lie. Groups without a netting key need no decision and are
spread by their other columns.

The groups are written once to the shared checkpoint folder, bucketed by partner: they
feed the sums and the distinct counts, and a later run can merge them.

The sample deviation of merged groups is exact for amounts below 1e8, taken in
millionths as the totals are: their sums and sums of squares are decimals, and the
squares are taken about the integer mean before they become a double, so equal
amounts give exactly 0. Amounts from 1e8 on are merged in doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.functions.scalar import MONEY_DECIMAL
from partnerwatch.operators.features import DISTINCT_COUNTS, FIRST_VALUES, split_busy
from partnerwatch.session import cut_by_key

LARGE, MILLIONTHS = 1e8, 1e6
_KEY, _NET = "_net_key", "_netted"

#: (source column, result) by how groups merge.
SUMS = (("NumberOfItems", "TotalItems"), ("ACDocCount", "ACDocCount"), ("ZCDocCount", "ZCDocCount"),
        ("IsHighValue", "HighValueCount"), ("IsExtremeValue", "ExtremeValueCount"),
        ("IsRoundAny", "RoundTransactionCount"))
MAXIMA = (("Amount", "MaxSingleAmount"), ("Balance", "Balance"), ("TotalDebit", "TotalDebit"),
          ("TotalCredit", "TotalCredit"), ("DaysOverdue", "MaxDaysOverdue"), ("ROSScore", "MaxROSScore"))
MEANS = (("DaysOverdue", "AvgDaysOverdue"), ("ROSScore", "AvgROSScore"))
#: Order of the result's columns after the counts and names.
MEASURES = ("ACDocCount", "ZCDocCount", "HighValueCount", "ExtremeValueCount", "Balance", "TotalDebit", "TotalCredit",
            "AvgDaysOverdue", "MaxDaysOverdue", "AvgROSScore", "MaxROSScore", "RoundTransactionCount")


def _moment_states(amount: str) -> list[Column]:
    """Sums that give count, total and squared deviations of merged groups."""
    x = F.col(amount).cast("double")
    units = F.when(F.abs(x) < LARGE, F.round(x * MILLIONTHS).cast("decimal(15,0)"))
    return [
        F.count(x).alias("_n"),
        F.sum(F.col(amount).cast(MONEY_DECIMAL)).alias("_total"),
        F.sum(units).alias("_k1"), F.sum(units * units).alias("_k2"),
        F.count_if(F.abs(x) >= LARGE).alias("_large"), F.sum(x).alias("_x1"), F.sum(x * x).alias("_x2"),
    ]


_MOMENTS = ("_n", "_total", "_k1", "_k2", "_large", "_x1", "_x2")


def _deviation() -> Column:
    """Sample standard deviation from merged moment states; NULL below two amounts."""
    n = F.col("_n").cast("double")
    count, mean = F.col("_n").cast("decimal(19,0)"), F.expr("cast(_k1 div _n as decimal(15,0))")
    about = F.col("_k2") - mean * F.col("_k1") * 2 + mean * mean * count
    off = (F.col("_k1") - mean * count).cast("double")
    exact = (about.cast("double") - off * off / n) / (MILLIONTHS * MILLIONTHS)
    in_doubles = F.col("_x2") - F.col("_x1") * F.col("_x1") / n
    both = F.when(F.col("_large") == 0, exact).otherwise(in_doubles)
    return F.when(F.col("_n") > 1, F.sqrt(F.greatest(both, F.lit(0.0)) / (n - 1.0)))


def _named(columns: list[str], doc_type_col: str) -> list[str]:
    return [c for c in dict.fromkeys([doc_type_col, *(c for c, _ in DISTINCT_COUNTS), *FIRST_VALUES]) if c in set(columns)]


def fold_ledger(df: DataFrame, partner_col: str = "BusinessPartner", amount_col: str = "Amount",
                doc_type_col: str = "CADocumentType", order_col: str = "CADocumentNumber",
                ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE) -> DataFrame:
    """Mergeable states per (partner, netting key, counted and named columns)."""
    have = set(df.columns)
    states = [F.count(F.lit(1)).alias("_rows"), *_moment_states(amount_col)]
    states += [F.sum(c).alias(f"_sum_{out}") for c, out in SUMS if c in have]
    states += [F.max(c).alias(f"_max_{out}") for c, out in MAXIMA if c in have]
    for c, out in MEANS:
        if c in have:
            states += [F.sum(F.col(c).cast("double")).alias(f"_mean_{out}"), F.count(c).alias(f"_of_{out}")]
    order = F.col(order_col) if order_col in have else F.lit(None).cast("string")
    key = F.when(F.col(doc_type_col).isin(ac_type, zc_type), F.bround(amount_col, 2))
    return df.withColumn(_KEY, key).groupBy(partner_col, _KEY, *_named(df.columns, doc_type_col)).agg(
        *states, F.min(order).alias("_order"))


def merge_groups(groups: DataFrame, partner_col: str = "BusinessPartner", doc_type_col: str = "CADocumentType") -> DataFrame:
    """Groups of several parts of a ledger (a union of ``fold_ledger`` results) as one."""
    keys = [partner_col, _KEY, *_named(groups.columns, doc_type_col)]
    largest = tuple(c for c in groups.columns if c.startswith("_max_"))
    added = [c for c in groups.columns if c.startswith("_") and c not in (*largest, "_order", _KEY, _NET)]
    # a sum keeps the type of the state, so merged states merge again
    merged = [F.sum(c).cast(groups.schema[c].dataType).alias(c) for c in added] + [F.max(c).alias(c) for c in largest]
    return groups.groupBy(*keys).agg(*merged, F.min("_order").alias("_order"))


def decide_netting(groups: DataFrame, partner_col: str = "BusinessPartner", doc_type_col: str = "CADocumentType",
                   ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE, near: bool = False) -> DataFrame:
    """``groups`` with ``_netted``: whether the rows of their key cancel. ``near`` says
    that a partner's groups lie in one task, so those without a key need no spreading."""
    kind = F.col(doc_type_col)
    apart = F.when(F.col(_KEY).isNull(), F.xxhash64(*_named(groups.columns, doc_type_col)))
    decided = Window.partitionBy(partner_col, _KEY, *(() if near else (apart,)))
    both = F.max((kind == ac_type).cast("int")).over(decided) + F.max((kind == zc_type).cast("int")).over(decided)
    return groups.withColumn(_NET, F.col(_KEY).isNotNull() & (both == 2))


def ledger_groups(df: DataFrame, partner_col: str = "BusinessPartner", order_col: str = "CADocumentNumber") -> DataFrame:
    """The folded ledger with the netting decision of each group."""
    return decide_netting(fold_ledger(df, partner_col, order_col=order_col), partner_col)


def netting_totals(groups: DataFrame, partner_col: str = "BusinessPartner") -> DataFrame:
    """J2 from groups: rows netted out and distinct partners affected (one row)."""
    netted = groups.filter(_NET).groupBy(partner_col).agg(F.sum("_rows").alias("_rows"))
    return netted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("netted_rows"),
                      F.count(partner_col).alias("netted_partners"))


def rollup_groups(groups: DataFrame, partner_col: str = "BusinessPartner", later: int = 0,
                  dated: str | None = None, together: bool = False) -> DataFrame:
    """A1 from groups: one row per partner over what is not netted; the same
    columns as ``features.aggregate_to_partner_level``. ``later`` is added to the
    days overdue, where the groups count them up to an earlier day; ``dated`` names a
    further column: how many rows have a due date. With ``together`` the distinct counts
    are part of the one aggregation, which holds the distinct values of a partner: right
    for groups that lie by partner, ``features.BUSY_ROWS`` a partner at most."""
    have = set(groups.columns)
    clean = ~F.col(_NET)
    kept = lambda c: F.when(clean, F.col(c))
    aggs = [F.sum(kept(c)).alias(c) for c in _MOMENTS]
    aggs += [F.sum(kept(f"_sum_{out}")).alias(out) for _, out in SUMS if f"_sum_{out}" in have]
    aggs += [F.max(kept(f"_max_{out}")).alias(out) for _, out in MAXIMA if f"_max_{out}" in have]
    aggs += [(F.sum(kept(f"_mean_{out}")) / F.sum(kept(f"_of_{out}"))).alias(out) for _, out in MEANS if f"_mean_{out}" in have]
    if dated:
        aggs.append(F.coalesce(F.sum(kept("_of_AvgDaysOverdue")), F.lit(0)).alias(dated))
    firsts = [c for c in FIRST_VALUES if c in have]
    aggs += [F.min(F.when(clean & F.col(c).isNotNull(), F.struct(F.col("_order").alias("o"), F.col(c).alias("v"))))["v"].alias(c)
             for c in firsts]
    aggs.append(F.coalesce(F.sum(F.when(~clean, F.col("_rows"))), F.lit(0)).alias("NettedPairsCount"))
    counted = [(c, out) for c, out in DISTINCT_COUNTS if c in have]
    if together:
        of_partner = F.col(partner_col).isNotNull()  # lines without a partner have no counts, as by the join below
        aggs += [F.size(F.collect_set(F.when(clean & of_partner, F.col(c).cast("string")))).cast("bigint").alias(out) for c, out in counted]
    rolled = groups.groupBy(partner_col).agg(*aggs).filter(F.col("_n") > 0)

    if counted and not together:
        triples = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v")) for i, (c, _) in enumerate(counted)])
        distinct = groups.filter(clean).select(partner_col, F.inline(triples)).filter(F.col("_v").isNotNull()).distinct()
        counts = distinct.groupBy(partner_col).agg(*[F.count_if(F.col("_i") == i).alias(out) for i, (_, out) in enumerate(counted)])
        rolled = rolled.join(counts, partner_col, "left")

    overdue = [c for c in ("AvgDaysOverdue", "MaxDaysOverdue") if c in rolled.columns]
    rolled = rolled.withColumns({c: F.col(c) + F.lit(later) for c in overdue}) if later else rolled
    total = F.col("_total").cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0))
    std, avg = zero(_deviation()), total / F.col("_n")
    out = rolled.withColumns({"TotalTransactions": F.col("_n"), "TotalAmount": total, "AvgAmount": avg, "StdAmount": std})
    measures = [c for c in MEASURES if c in out.columns]
    named = ["TotalTransactions", "TotalAmount", "AvgAmount", "StdAmount", "MaxSingleAmount",
             *(c for c in ("TotalItems",) if c in out.columns), *(c for _, c in counted), *measures]
    out = out.select(partner_col, *firsts, *[zero(F.col(c)).alias(c) for c in named], *([dated] if dated else []), "NettedPairsCount")
    derived = {}
    if {"ZCDocCount", "ACDocCount"} <= set(named):
        derived["ReversalRatio"] = F.col("ZCDocCount") / (F.col("ACDocCount") + 1)
    derived["AmountVolatility"] = F.col("StdAmount") / (F.col("AvgAmount") + 1)
    if "RoundTransactionCount" in named:
        derived["RoundTransactionRate"] = F.col("RoundTransactionCount") / (F.col("TotalTransactions") + 1)
    out = out.withColumns(derived)
    return out.select(*[c for c in out.columns if c != "NettedPairsCount"], "NettedPairsCount")


def rollup_table(groups: DataFrame, partner_col: str = "BusinessPartner", later: int = 0, dated: str | None = None,
                 most: int | None = None, near: bool = False) -> DataFrame:
    """``rollup_groups`` of groups that are written once, bucketed by partner, so that
    sums and distinct counts shuffle no group; partners of more than ``most`` groups
    (``features.BUSY_ROWS``) are spread. ``near`` says that the groups lie by partner
    already and none is busy: then nothing is written."""
    if near:
        return rollup_groups(groups, partner_col, later, dated, together=True)
    few, busy = split_busy(*cut_by_key(groups, partner_col, "ledger-groups"), partner_col, most)
    return rollup_groups(few, partner_col, later, dated).unionByName(rollup_groups(busy, partner_col, later, dated))


def netted_rollup(df: DataFrame, partner_col: str = "BusinessPartner", order_col: str = "CADocumentNumber") -> DataFrame:
    """J1 + J3 + A1: one row per partner over the rows that no cancellation nets."""
    return rollup_table(ledger_groups(df, partner_col, order_col=order_col), partner_col)
