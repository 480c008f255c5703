"""J1 in one-to-one mode: the i-th credit of a key meets the i-th reversal.

A key is a partner and an amount rounded half-even to cents. Where a key has a
credits and z reversals, the first min(a, z) of each, in the order given, cancel
in pairs; what is left over of the longer side stays. (Set mode, in
``features.net_cancellation_pairs``, nets every row of such a key.)

Ranks come from one range sort by (partner, amount, type, order), written once with
each row's place, so a key that holds most of the ledger lies in many tasks. Only
segments, one row per key and task, are added up by a window; a row's rank is its
place in its segment plus the rows of the segments before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.session import cut_lineage

_NET, _PART, _ROW = "_net_amount", "_net_part", "_net_row"


def ranked_candidates(df: DataFrame, partner_col: str, amount_col: str, doc_type_col: str, order_col: str,
                      ac_type: str, zc_type: str) -> DataFrame:
    """Credit and reversal rows with ``NetRank`` (from 1, in their key and type) and
    ``NetPairs`` (pairs of their key). Rows equal in ``order_col`` go by a hash of
    the row."""
    key = [partner_col, _NET, doc_type_col]
    rows = df.filter(F.col(doc_type_col).isin(ac_type, zc_type) & F.col(amount_col).isNotNull())
    rows = rows.withColumn(_NET, F.bround(amount_col, 2))
    order = [*key, F.col(order_col), F.xxhash64(*df.columns)]
    i = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumns({_PART: F.shiftright(i, 33).cast("int"), _ROW: i}), "netting-candidates")

    segments = placed.groupBy(*key, _PART).agg(F.count(F.lit(1)).alias("_held"), F.min(_ROW).alias("_first"))
    before = Window.partitionBy(*key).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key[:2])
    of = lambda t: F.coalesce(F.sum(F.when(F.col(doc_type_col) == t, F.col("_held"))).over(whole), F.lit(0))
    segments = segments.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate((*key, _PART))], "_first",
                               F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"),
                               F.least(of(ac_type), of(zc_type)).alias("NetPairs"))
    met = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate((*key, _PART))]
    rank = F.col("_before") + F.col(_ROW) - F.col("_first") + 1
    return placed.join(segments, met).select(*df.columns, rank.alias("NetRank"), "NetPairs")


def net_one_to_one(df: DataFrame, partner_col: str = "BusinessPartner", amount_col: str = "Amount",
                   doc_type_col: str = "CADocumentType", order_col: str = "CADocumentNumber",
                   ac_type: str = C.CREDIT_DOC_TYPE, zc_type: str = C.REVERSAL_DOC_TYPE) -> DataFrame:
    """``df`` with ``IsNetted`` (1 on rows that cancel one of the other type) and
    ``NetPair`` (the pair's number in its key, NULL elsewhere)."""
    ranked = ranked_candidates(df, partner_col, amount_col, doc_type_col, order_col, ac_type, zc_type)
    paired = F.col("NetRank") <= F.col("NetPairs")
    netted = ranked.select(*df.columns, paired.cast("int").alias("IsNetted"), F.when(paired, F.col("NetRank")).alias("NetPair"))
    is_candidate = F.col(doc_type_col).isin(ac_type, zc_type) & F.col(amount_col).isNotNull()
    others = df.filter(~F.coalesce(is_candidate, F.lit(False)))
    return netted.unionByName(others.withColumns({"IsNetted": F.lit(0), "NetPair": F.lit(None).cast("bigint")}))
