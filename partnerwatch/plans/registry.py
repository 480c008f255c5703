"""Driver registry: one Spark query per operator of the survey inventory, each
reading the given tables, plus its DuckDB oracle where SQL can express it.

Floating outputs are rounded identically on both sides (money aggregates to
cents, everything else to 6-9 decimals) so the driver's value hash does not
see summation-order noise.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerwatch import config as C
from partnerwatch.functions import stats
from partnerwatch.operators import alerts, explore, features, iforest, pairing, peers, rollup, silver
from partnerwatch.plans import oracles as O
from partnerwatch.plans import pipeline as P
from partnerwatch.sources import fixtures as FX
from partnerwatch.sources import odata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MONEY_2DP = {"StdAmount"}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def r(c: str | Column, d: int = 6) -> Column:
    """round(x * 10^d) / 10^d: the same double arithmetic as ``R`` in SQL, so
    identical inputs give identical outputs (plain ``round(x, d)`` differs
    between engines on values like 12493.154999999999)."""
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** d)
    return F.round(col * F.lit(scale)) / F.lit(scale)


def R(expr: str, d: int = 6) -> str:
    """SQL twin of ``r``."""
    return f"(round(({expr}) * {float(10 ** d)!r}) / {float(10 ** d)!r})"


def rounded(df: DataFrame, digits: int = 6, money: set[str] = MONEY_2DP) -> DataFrame:
    """Round every double column (money aggregates to cents)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(r(f.name, 2 if f.name in money else digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sql_round(cols: list[str], digits: int = 6, money: set[str] = MONEY_2DP) -> str:
    return ", ".join(f"{R(c, 2 if c in money else digits)} AS {c}" for c in cols)


MSUM = "CAST(sum(CAST(Amount AS DECIMAL(38,6))) AS DOUBLE)"


# ------------------------------------------------------------------ helpers
def _silver(spark, sf):
    return P.fixture_silver(spark, sf)


def _tx(spark, sf):
    return P.transactions(_silver(spark, sf), FX.LEDGER_AS_OF)


def _partners(spark, sf):
    """Partner table written once to the checkpoint folder: the queries below
    read it at least twice (statistics, then the join back)."""
    from partnerwatch.session import cut_lineage

    return cut_lineage(P.fixture_partners(spark, sf), "partners")


ROLLUP_COLS = [
    "BusinessPartner", "BusinessPartnerName", "Segment", "TransactionType", "TotalTransactions", "TotalAmount",
    "AvgAmount", "StdAmount", "MaxSingleAmount", "TotalItems", "UniqueDocTypes", "UniqueMainTransactions",
    "UniqueContracts", "ACDocCount", "ZCDocCount", "HighValueCount", "ExtremeValueCount", "Balance", "TotalDebit",
    "TotalCredit", "AvgDaysOverdue", "MaxDaysOverdue", "AvgROSScore", "MaxROSScore", "RoundTransactionCount",
    "ReversalRatio", "AmountVolatility", "RoundTransactionRate", "NettedPairsCount", "PeerGroup",
]
ROLLUP_DOUBLES = [
    "TotalAmount", "AvgAmount", "StdAmount", "MaxSingleAmount", "Balance", "TotalDebit", "TotalCredit",
    "AvgDaysOverdue", "AvgROSScore", "MaxROSScore", "ReversalRatio", "AmountVolatility", "RoundTransactionRate",
]


# ------------------------------------------------------------------ P1-P9
SILVER_COLS = ["BusinessPartner", "BusinessPartnerName", "FirstName", "LastName", "PostalCode", "CompanyCode",
               "ContractAccount", "CADocumentNumber", "CADocumentType", "CAMainTransaction", "CASubTransaction",
               "CAAccountDeterminationCode", "Amount", "Balance", "TotalDebit", "TotalCredit", "NumberOfItems",
               "NetDueDate"]


@register("silver_transactions", O.with_ledger(f"SELECT {', '.join(SILVER_COLS)} FROM silver"))
def q_silver(spark, sf):
    """The silver job over the all-text bronze ledger."""
    return P.fixture_staged(spark, sf)


@register("bronze_csv_to_silver", O.with_ledger(f"SELECT {', '.join(SILVER_COLS)} FROM silver"))
def q_bronze_csv(spark, sf):
    """S2 + X1: the ledger written as CSV with the source's further columns and in
    another column order, read back by header names and typed."""
    from partnerwatch.schemas import BRONZE_TEXT_COLUMNS
    from partnerwatch.session import checkpoint_dir
    from partnerwatch.sources import files

    extra = [c for c in C.BRONZE_DROP_COLUMNS if c not in BRONZE_TEXT_COLUMNS]
    wide = FX.ledger_bronze(spark, sf).select("*", *[F.concat(F.lit(f"{i}-"), "CADocumentNumber").alias(c)
                                                     for i, c in enumerate(extra)])
    path = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/bronze-csv-{uuid.uuid4().hex}"
    files.write_bronze_csv(wide.select(*sorted(wide.columns, reverse=True)), path)
    return silver.build_silver(silver.drop_columns(files.read_bronze_csv(spark, path), C.BRONZE_DROP_COLUMNS))


_BAD = "CAST(substr(CADocumentNumber, 1, 19) AS BIGINT) % 40"
_CAUSE = (f"CASE {_BAD} WHEN 0 THEN 'AmountInDisplayCurrency: not a number' WHEN 1 THEN 'AmountInDisplayCurrency: not finite' "
          "WHEN 2 THEN 'BusinessPartner: missing' WHEN 3 THEN 'AmountInDisplayCurrency: missing; BusinessPartner: missing' "
          "WHEN 4 THEN 'AmountInDisplayCurrency: too large' END")


def _judged_landing(spark, sf) -> str:
    """The ledger as compressed CSV, some lines damaged, landed by one job into both sinks."""
    from partnerwatch.session import checkpoint_dir
    from partnerwatch.sources import files

    bad = F.substring("CADocumentNumber", 1, 19).cast("bigint") % 40
    amount = (F.when(bad == 0, "n/a").when(bad == 1, "-Infinity").when(bad == 3, F.lit(None)).when(bad == 4, "1e33")
              .otherwise(F.col("AmountInDisplayCurrency")))
    partner = F.when(bad.isin(2, 3), F.lit(None)).otherwise(F.col("BusinessPartner"))
    lines = FX.ledger_bronze(spark, sf).withColumns({"AmountInDisplayCurrency": amount, "BusinessPartner": partner})
    base = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/judged-{uuid.uuid4().hex}"
    files.write_bronze_csv(lines, f"{base}/bronze")
    files.write_judged(silver.judged_lines(files.read_placed_csv(spark, f"{base}/bronze")), f"{base}/judged")
    return f"{base}/judged"


@register("rejected_lines", O.with_ledger(
    f"SELECT CADocumentNumber, {_CAUSE} AS cause FROM silver WHERE {_BAD} < 5"))
def q_rejected_lines(spark, sf):
    """Rejected lines with their causes by column, from the second sink."""
    from partnerwatch.sources import files

    rows = files.read_rejected(spark, _judged_landing(spark, sf))
    return rows.select(F.get_json_object("raw", "$.CADocumentNumber").alias("CADocumentNumber"), F.array_join("causes", "; ").alias("cause"))


@register("landing_reconciled", O.with_ledger(
    f"SELECT coalesce({_CAUSE}, 'kept') AS cause, count(*) AS lines FROM silver GROUP BY 1"))
def q_landing_reconciled(spark, sf):
    """Kept and rejected lines by cause add up to the bronze lines."""
    from partnerwatch.sources import files

    return files.reconciled(spark, _judged_landing(spark, sf))


_NUMBER_TEXTS = ["3.0", " 12 ", "+7", "-4", "2.5", "99999999999", "n/a", ""]
_DATE_TEXTS = ["/Date(0)/", "/Date(-86400000)/", "/Date(86400000+0200)/", "/Date(99999999999999999)/",
               "/Date(99999999999999999999999)/", "0", "/Date()/", "/Date(253402300800000)/"]


@register("lenient_texts",
          "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 3 WHEN 1 THEN 12 WHEN 2 THEN 7 WHEN 3 THEN -4 END "
          "AS whole, CASE o_orderkey % 8 WHEN 0 THEN 3.0 WHEN 1 THEN 12.0 WHEN 2 THEN 7.0 WHEN 3 THEN -4.0 "
          "WHEN 4 THEN 2.5 WHEN 5 THEN 99999999999.0 END::DOUBLE AS number, CASE o_orderkey % 8 "
          "WHEN 0 THEN TIMESTAMP '1970-01-01' WHEN 1 THEN TIMESTAMP '1969-12-31' WHEN 2 THEN TIMESTAMP '1970-01-02' "
          "END AS due FROM orders")
def q_lenient_texts(spark, sf):
    """P3, P4 on texts with junk, signs, fractions and numbers out of range."""
    from partnerwatch.functions.scalar import lenient_double, lenient_int, parse_epoch_date
    orders = FX.table(spark, sf, "orders").select("o_orderkey")
    pick = lambda texts: F.element_at(F.array(*map(F.lit, texts)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    number = pick(_NUMBER_TEXTS)
    return orders.select("o_orderkey", lenient_int(number).alias("whole"), lenient_double(number).alias("number"),
                         parse_epoch_date(pick(_DATE_TEXTS)).alias("due"))


@register("lenient_cast", O.with_ledger(
    "SELECT CADocumentNumber, Amount AS amount_value, TRY_CAST(BusinessPartnerName AS DOUBLE) AS name_value, "
    "NumberOfItems AS items_value FROM silver"))
def q_lenient_cast(spark, sf):
    from partnerwatch.functions.scalar import lenient_double, lenient_int
    b = FX.ledger_bronze(spark, sf)
    return b.select("CADocumentNumber",
                    F.abs(lenient_double("AmountInDisplayCurrency")).alias("amount_value"),
                    lenient_double("BusinessPartnerName").alias("name_value"),
                    lenient_int("NumberOfItems").alias("items_value"))


@register("sap_date_parse", O.with_ledger(
    "SELECT CADocumentNumber, '/Date(' || CAST(epoch_ms(NetDueDate) AS VARCHAR) || ')/' AS raw_text, "
    "NetDueDate AS parsed FROM silver"))
def q_sap_date(spark, sf):
    from partnerwatch.functions.scalar import parse_epoch_date
    b = FX.ledger_bronze(spark, sf)
    return b.select("CADocumentNumber", F.col("CANetDueDate").alias("raw_text"),
                    parse_epoch_date("CANetDueDate").alias("parsed"))


@register("days_overdue", O.with_ledger(
    "SELECT CADocumentNumber, DaysOverdue, CAST(greatest(DaysOverdue, 0) AS INTEGER) AS DaysOverdueClipped FROM sig"))
def q_days_overdue(spark, sf):
    s = P.fixture_staged(spark, sf)
    a = silver.add_days_overdue(s, FX.LEDGER_AS_OF)
    a = silver.add_days_overdue(a, FX.LEDGER_AS_OF, clip_negative=True, out_col="DaysOverdueClipped")
    return a.select("CADocumentNumber", "DaysOverdue", "DaysOverdueClipped")


@register("pseudonymise",
          "SELECT CAST(c_custkey AS VARCHAR) AS BusinessPartner, "
          "CASE WHEN c_name IS NULL OR trim(c_name) = '' THEN 'CUSTOMER_UNKNOWN' "
          "ELSE 'CUSTOMER_' || upper(substr(md5(c_name), 1, 6)) END AS BusinessPartnerName, "
          "'REDACTED' AS FirstName, 'REDACTED' AS LastName, 'REDACTED' AS PostalCode FROM customer")
def q_pseudonymise(spark, sf):
    cust = FX.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("BusinessPartner"), F.col("c_name").alias("BusinessPartnerName"))
    return silver.pseudonymise(cust)


# ------------------------------------------------------------------ P10-P16
def _sig_query(cols: list[str], doubles: list[str] = (), digits: int = 9):
    def q(spark, sf):
        tx = features.add_transaction_signals(silver.add_days_overdue(_silver(spark, sf), FX.LEDGER_AS_OF))
        return tx.select("CADocumentNumber", *[r(c, digits).alias(c) if c in doubles else F.col(c) for c in cols])
    sel = ", ".join(f"{R(c, digits)} AS {c}" if c in doubles else c for c in cols)
    return q, O.with_ledger(f"SELECT CADocumentNumber, {sel} FROM sig2")


for _key, _cols, _dbl in [
    ("reversal_flags", ["CADocumentType", "ACDocCount", "ZCDocCount"], []),
    ("value_flags", ["Amount", "IsHighValue", "IsExtremeValue"], []),
    ("ros_score", ["Amount", "ROSScore"], ["ROSScore"]),
    ("round_flags", ["Amount"] + [f"IsRound{t}" for t in C.ROUND_THRESHOLDS] + ["IsRoundAny"], []),
    ("segment_label", ["CAAccountDeterminationCode", "Segment"], []),
    ("txn_type_label", ["CAMainTransaction", "TransactionType"], []),
]:
    _q, _sql = _sig_query(_cols, _dbl)
    register(_key, _sql)(_q)


@register("peer_groups", O.with_ledger(
    "SELECT PeerGroup, count(*) AS partners FROM partners GROUP BY PeerGroup"))
def q_peer_groups(spark, sf):
    return P.fixture_partners(spark, sf).groupBy("PeerGroup").agg(F.count(F.lit(1)).alias("partners"))


# ------------------------------------------------------------------ J1, J2
@register("net_pairs", O.with_ledger(
    "SELECT CADocumentNumber, BusinessPartner, CADocumentType, Amount, IsNetted FROM tx"))
def q_net_pairs(spark, sf):
    return _tx(spark, sf).select("CADocumentNumber", "BusinessPartner", "CADocumentType", "Amount", "IsNetted")


@register("net_summary", O.with_ledger(
    "SELECT CAST(sum(IsNetted) AS BIGINT) AS netted_rows, "
    "count(DISTINCT BusinessPartner) FILTER (WHERE IsNetted = 1) AS netted_partners FROM tx"))
def q_net_summary(spark, sf):
    return features.netting_summary(_tx(spark, sf))


@register("net_summary_folded", ORACLES["net_summary"])
def q_net_summary_folded(spark, sf):
    """J1, J2 from ledger groups: one scan, no row join."""
    return rollup.netting_totals(rollup.ledger_groups(P.signals(_silver(spark, sf), FX.LEDGER_AS_OF)))


@register("net_pairs_one_to_one", O.with_ledger(
    "SELECT CADocumentNumber, BusinessPartner, CADocumentType, Amount, coalesce(CAST(rk <= pairs AS INTEGER), 0) AS IsNetted, "
    "CASE WHEN rk <= pairs THEN rk END AS NetPair FROM (SELECT s.*, "
    "CASE WHEN CADocumentType IN ('AC', 'ZC') THEN row_number() OVER "
    "(PARTITION BY BusinessPartner, round_even(Amount, 2), CADocumentType ORDER BY CADocumentNumber) END AS rk, "
    "least(count(*) FILTER (CADocumentType = 'AC') OVER (PARTITION BY BusinessPartner, round_even(Amount, 2)), "
    "count(*) FILTER (CADocumentType = 'ZC') OVER (PARTITION BY BusinessPartner, round_even(Amount, 2))) AS pairs "
    "FROM sig2 s)"))
def q_net_pairs_one_to_one(spark, sf):
    """Each credit cancels one reversal of its partner and amount."""
    tx = pairing.net_one_to_one(_silver(spark, sf).select("CADocumentNumber", "BusinessPartner", "CADocumentType", "Amount"))
    return tx.select("CADocumentNumber", "BusinessPartner", "CADocumentType", "Amount", "IsNetted", "NetPair")


# ------------------------------------------------------------------ A1, A2
@register("partner_rollup", O.with_ledger(
    "SELECT " + ", ".join(
        f"{R(c, 2 if c in MONEY_2DP else 6)} AS {c}" if c in ROLLUP_DOUBLES else c for c in ROLLUP_COLS)
    + " FROM partners"))
def q_partner_rollup(spark, sf):
    return rounded(P.fixture_partners(spark, sf).select(*ROLLUP_COLS))


@register("partner_rollup_folded", ORACLES["partner_rollup"])
def q_partner_rollup_folded(spark, sf):
    """J1, J3, A1 from ledger groups: one scan of the ledger."""
    return rounded(P.partners(_silver(spark, sf), FX.LEDGER_AS_OF, folded=True).select(*ROLLUP_COLS))


@register("incremental_partners", O.with_ledger(
    "SELECT " + ", ".join(
        f"{R(c, 2 if c in MONEY_2DP else 6)} AS {c}" if c in ROLLUP_DOUBLES else c for c in ROLLUP_COLS)
    + " FROM partners"))
def q_incremental_partners(spark, sf):
    """X3 over what changed: the ledger lands in three parts on three days, the second
    one first without some of its lines and then corrected. The silver lines are written
    once, by part; each landing reads its own."""
    from datetime import timedelta

    from partnerwatch.plans import incremental
    from partnerwatch.session import checkpoint_dir

    base = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/landings-{uuid.uuid4().hex}"
    dealt = _silver(spark, sf).withColumn("_part", F.pmod(F.crc32(F.col("CADocumentNumber").cast("binary")), F.lit(3)))
    dealt.write.partitionBy("_part").option("compression", "zstd").parquet(f"{base}/silver")
    lines = spark.read.schema(dealt.schema).parquet(f"{base}/silver")
    part = lambda i: lines.filter(F.col("_part") == i).drop("_part")
    day = FX.LEDGER_AS_OF
    incremental.land(spark, base, "first", part(0), day - timedelta(days=9))
    incremental.land(spark, base, "second", part(1).filter("NumberOfItems > 10"), day - timedelta(days=4))
    incremental.land(spark, base, "third", part(2), day - timedelta(days=1))
    return rounded(incremental.land(spark, base, "second", part(1), day).select(*ROLLUP_COLS))


RAW_COLS = list(features.SLIM_ROLLUP_COLUMNS)


@register("partner_rollup_raw", O.with_ledger(
    "SELECT BusinessPartner, "
    "arg_min(BusinessPartnerName, CADocumentNumber) FILTER (WHERE BusinessPartnerName IS NOT NULL) AS BusinessPartnerName, "
    "arg_min(Segment, CADocumentNumber) FILTER (WHERE Segment IS NOT NULL) AS Segment, "
    f"count(Amount) AS TotalTransactions, {R(MSUM)} AS TotalAmount, {R(MSUM + ' / count(Amount)')} AS AvgAmount, "
    f"{R('coalesce(stddev_samp(Amount), 0)', 2)} AS StdAmount, {R('max(Amount)')} AS MaxSingleAmount, "
    "CAST(sum(ACDocCount) AS BIGINT) AS ACDocCount, CAST(sum(ZCDocCount) AS BIGINT) AS ZCDocCount, "
    "CAST(sum(IsHighValue) AS BIGINT) AS HighValueCount, CAST(sum(IsExtremeValue) AS BIGINT) AS ExtremeValueCount, "
    f"{R('max(Balance)')} AS Balance, {R('max(TotalDebit)')} AS TotalDebit, "
    f"{R('sum(ZCDocCount) / (sum(ACDocCount) + 1)')} AS ReversalRatio, "
    f"{R('coalesce(stddev_samp(Amount), 0) / (' + MSUM + ' / count(Amount) + 1)')} AS AmountVolatility "
    "FROM sig2 GROUP BY BusinessPartner"))
def q_partner_rollup_raw(spark, sf):
    tx = features.add_transaction_signals(_silver(spark, sf))
    return rounded(features.partner_rollup_raw(tx))


# ------------------------------------------------------------------ W1-W3
Z_COLS = list(C.ZSCORE_COLUMNS)


@register("peer_zscores", O.with_ledger(
    "SELECT p.BusinessPartner, p.PeerGroup, " + ", ".join(
        f"{R(f'(p.{c} - g.{c}__m) / CASE WHEN g.{c}__s = 0 THEN 1 ELSE g.{c}__s END')} AS {c}_zscore" for c in Z_COLS)
    + " FROM partners p JOIN (SELECT PeerGroup, " + ", ".join(
        f"avg({c}) AS {c}__m, stddev_samp({c}) AS {c}__s" for c in Z_COLS)
    + " FROM partners GROUP BY PeerGroup) g ON p.PeerGroup = g.PeerGroup"))
def q_peer_zscores(spark, sf):
    z = peers.add_peer_zscores(_partners(spark, sf), Z_COLS, "PeerGroup", C.peer_group_bound())
    return z.select("BusinessPartner", "PeerGroup", *[r(f"{c}_zscore").alias(f"{c}_zscore") for c in Z_COLS])


FEATS = list(C.MODEL_FEATURES)


@register("iqr_scores", O.with_ledger(
    "SELECT BusinessPartner, PeerGroup, " + ", ".join(f"{R(c + '_iqr_score')} AS {c}_iqr_score" for c in FEATS)
    + " FROM iqr", extra_ctes=O.iqr_cte()))
def q_iqr_scores(spark, sf):
    s, _ = peers.iqr_scores(_partners(spark, sf), FEATS, "PeerGroup", C.peer_group_bound())
    return s.select("BusinessPartner", "PeerGroup", *[r(f"{c}_iqr_score").alias(f"{c}_iqr_score") for c in FEATS])


@register("iqr_flags", O.with_ledger(
    f"SELECT BusinessPartner, PeerGroup, {R('iqr_max_score')} AS iqr_max_score, iqr_flag, iqr_triggered_cols "
    "FROM iqr", extra_ctes=O.iqr_cte()))
def q_iqr_flags(spark, sf):
    s = peers.score_features_by_segment(_partners(spark, sf), FEATS, "PeerGroup", 2.0, C.peer_group_bound())
    return s.select("BusinessPartner", "PeerGroup", r("iqr_max_score").alias("iqr_max_score"), "iqr_flag",
                    "iqr_triggered_cols")


# ------------------------------------------------------------------ A3-A16, H1, H2, W5, M1


def _sig(spark, sf):
    return features.add_transaction_signals(silver.add_days_overdue(_silver(spark, sf), FX.LEDGER_AS_OF))


def _raw_partners(spark, sf):
    from partnerwatch.session import cut_lineage

    return cut_lineage(features.partner_rollup_raw(features.add_transaction_signals(_silver(spark, sf))),
                       "raw-partners")


ZC_OVER_AC = ("count(*) FILTER (WHERE CADocumentType = 'ZC') "
              "/ (count(*) FILTER (WHERE CADocumentType = 'AC') + 1)")


@register("segment_overview", O.with_ledger(
    f"SELECT Segment, count(Amount) AS Transactions, {R(MSUM)} AS TotalAmount, "
    f"{R(MSUM + ' / count(Amount)')} AS AvgAmount, count(DISTINCT BusinessPartner) AS UniquePartners, "
    "round_even(count(Amount) / sum(count(Amount)) OVER () * 100 * 10.0, 0) / 10.0 AS PctTransactions "
    "FROM sig2 GROUP BY Segment"))
def q_segment_overview(spark, sf):
    return rounded(explore.segment_overview(_sig(spark, sf)))


@register("doc_type_counts", O.with_ledger(
    "SELECT CADocumentType AS DocumentType, count(*) AS Count FROM silver "
    "WHERE CADocumentType IS NOT NULL GROUP BY 1"))
def q_doc_type_counts(spark, sf):
    return explore.doc_type_counts(_silver(spark, sf))


@register("global_reversal_ratio", O.with_ledger(
    "SELECT count(*) FILTER (WHERE CADocumentType = 'AC') AS ac_total, "
    "count(*) FILTER (WHERE CADocumentType = 'ZC') AS zc_total, "
    f"{R(ZC_OVER_AC)} AS global_ratio "
    "FROM silver"))
def q_global_reversal_ratio(spark, sf):
    return rounded(explore.global_reversal_ratio(_silver(spark, sf)))


@register("monthly_series", O.with_ledger(
    f"SELECT strftime(NetDueDate, '%Y-%m') AS month, count(Amount) AS transaction_count, "
    f"{R(MSUM)} AS total_amount FROM silver WHERE NetDueDate IS NOT NULL GROUP BY 1"))
def q_monthly_series(spark, sf):
    return rounded(explore.monthly_series(_silver(spark, sf)))


@register("amount_summary", O.with_ledger(
    f"SELECT {R('max(Amount)')} AS largest, count(*) FILTER (WHERE Amount > 10000) AS over_10k, "
    f"count(*) FILTER (WHERE Amount > 100000) AS over_100k, {R('quantile_cont(Amount, 0.5)')} AS median, "
    f"{R('quantile_cont(Amount, 0.99)')} AS p99 FROM silver"))
def q_amount_summary(spark, sf):
    return rounded(explore.amount_summary(_silver(spark, sf)))


@register("data_profile", O.with_ledger(
    f"SELECT count(*) AS rows, CAST({len(SILVER_COLS)} AS BIGINT) AS columns, "
    "count(DISTINCT BusinessPartner) AS partners, min(NetDueDate) AS first_date, max(NetDueDate) AS last_date "
    "FROM silver"))
def q_data_profile(spark, sf):
    return explore.data_profile(_silver(spark, sf))


def _long_sql(source: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {source}" for c in cols)


@register("feature_describe", O.with_ledger(
    f"SELECT feature, {R('avg(v)')} AS mean, {R('stddev_samp(v)')} AS std, {R('min(v)')} AS min, "
    f"{R('quantile_cont(v, 0.5)')} AS p50, {R('max(v)')} AS max "
    f"FROM ({_long_sql('partners', FEATS)}) GROUP BY feature"))
def q_feature_describe(spark, sf):
    return rounded(explore.describe_features(_partners(spark, sf), FEATS))


def _one_pass_sql() -> str:
    cols = (f"count(*) AS rows, count(Amount) AS transactions, {R(MSUM)} AS total_amount, {R('max(Amount)')} AS largest, "
            f"{R('min(Amount)')} AS smallest, count(*) FILTER (Amount > 10000) AS over_10k, count(*) FILTER (Amount > 100000) AS over_100k, "
            "count(DISTINCT BusinessPartner) AS partners, min(NetDueDate) AS first_date, max(NetDueDate) AS last_date FROM sig2")
    return " UNION ALL ".join(f"SELECT '{p}' AS part, {k} AS key, {cols}{f' GROUP BY {k}' if p != 'all' else ''}" for p, k in (
        ("segment", "Segment"), ("doc_type", "CADocumentType"), ("month", "strftime(NetDueDate, '%Y-%m')"),
        ("all", "CAST(NULL AS VARCHAR)")))


@register("eda_one_pass", O.with_ledger(_one_pass_sql()))
def q_eda_one_pass(spark, sf):
    """The exploration tables of the ledger from one scan."""
    return rounded(explore.one_pass(_sig(spark, sf)))


_SKETCH_PROBS, _SKETCH_K, _LG_K = (0.01, 0.25, 0.5, 0.75, 0.95, 0.99), 200, 10


@register("sketched_quantiles", O.with_ledger(
    "SELECT Segment, p AS prob, count(Amount) AS n, TRUE AS within FROM sig2, (VALUES "
    + ", ".join(f"({p!r}::DOUBLE)" for p in _SKETCH_PROBS) + ") t(p) GROUP BY ALL"))
def q_sketched_quantiles(spark, sf):
    """W2, A8, A10, option: amounts by segment from KLL sketches of each month, merged;
    ``within``: the value's exact rank lies within the stated error of its probability."""
    tx = features.add_segment_label(_silver(spark, sf))
    tx = tx.withColumn("month", F.date_format("NetDueDate", "yyyy-MM"))
    merged = stats.merge_sketches(stats.quantile_sketches(tx, ["Segment", "month"], ["Amount"], _SKETCH_K), ["Segment"])
    q = stats.sketched_quantiles(merged, ["Segment"], _SKETCH_PROBS)
    pairs = F.array(*[F.struct(F.lit(p).alias("prob"), F.col(f"q{i}").alias("value")) for i, p in enumerate(_SKETCH_PROBS)])
    long = q.select("Segment", "n", F.inline(pairs))
    amounts = tx.groupBy(F.col("Segment").alias("_s"), "Amount").agg(F.count(F.lit(1)).alias("_c"))
    ranks = long.join(amounts, F.col("Segment") == F.col("_s")).groupBy("Segment", "prob", "n", "value").agg(
        F.sum(F.when(F.col("Amount") < F.col("value"), F.col("_c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("Amount") <= F.col("value"), F.col("_c")).otherwise(0)).alias("upto"))
    error = stats.rank_error(_SKETCH_K)
    within = (F.col("below") / F.col("n") <= F.col("prob") + error) & (F.col("upto") / F.col("n") >= F.col("prob") - error)
    return ranks.select("Segment", "prob", "n", within.alias("within"))


@register("sketched_distinct", O.with_ledger(
    "SELECT Segment, count(DISTINCT BusinessPartner) AS partners, count(DISTINCT CADocumentNumber) AS documents, "
    "TRUE AS within FROM sig2 GROUP BY Segment"))
def q_sketched_distinct(spark, sf):
    """A1d, option: distinct partners and documents of a segment from theta sketches of
    each month, merged; ``within``: three times the stated relative error."""
    tx = features.add_segment_label(_silver(spark, sf)).withColumn("month", F.date_format("NetDueDate", "yyyy-MM"))
    cols = ["BusinessPartner", "CADocumentNumber"]
    told = stats.union_distinct(stats.distinct_sketches(tx, ["Segment", "month"], cols, _LG_K), ["Segment"], cols, _LG_K)
    exact = tx.groupBy(F.col("Segment").alias("_s")).agg(F.count_distinct("BusinessPartner").alias("partners"),
                                                         F.count_distinct("CADocumentNumber").alias("documents"))
    most = 3.0 / 2 ** (_LG_K / 2)
    near = lambda a, b: F.abs(F.col(a) / F.col(b) - 1) <= most
    both = told.join(exact, F.col("Segment") == F.col("_s"))
    return both.select("Segment", "partners", "documents",
                       (near("BusinessPartner__distinct", "partners") & near("CADocumentNumber__distinct", "documents")).alias("within"))


EDA8 = list(explore.EDA_FEATURES)
EDA10 = list(explore.EDA_CORR_FEATURES)


@register("feature_skew", O.with_ledger(
    f"SELECT feature, {R('skewness(v)')} AS skew, coalesce(abs(skewness(v)) > 5.0, FALSE) AS highly_skewed "
    f"FROM ({_long_sql('raw_partners', EDA8)}) GROUP BY feature"))
def q_feature_skew(spark, sf):
    return rounded(explore.feature_skew(_raw_partners(spark, sf), EDA8))


def _corr_sql(source: str, cols, threshold: float | None = None) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM {source}")
    body = " UNION ALL ".join(parts)
    cond = f" WHERE abs(r) > {threshold!r}" if threshold is not None else ""
    return (f"SELECT feature_a, feature_b, {R('CASE WHEN isnan(r) THEN NULL ELSE r END')} AS r "
            f"FROM ({body}){cond}")


@register("feature_corr", O.with_ledger(_corr_sql("raw_partners", EDA10)))
def q_feature_corr(spark, sf):
    return rounded(explore.feature_correlation(_raw_partners(spark, sf), EDA10))


@register("corr_pairs", O.with_ledger(_corr_sql("raw_partners", EDA10, 0.7)))
def q_corr_pairs(spark, sf):
    return rounded(explore.correlated_pairs(_raw_partners(spark, sf), EDA10, 0.7))


@register("iqr_breakdown", O.with_ledger(
    "SELECT Segment, count(BusinessPartner) AS Partners, count(*) FILTER (WHERE iqr_flag) AS IQR_Flagged, "
    "round_even(count(*) FILTER (WHERE iqr_flag) / count(BusinessPartner) * 100 * 10.0, 0) / 10.0 AS PctFlagged "
    "FROM iqr GROUP BY Segment", extra_ctes=O.iqr_cte(group="Segment")))
def q_iqr_breakdown(spark, sf):
    scored = peers.score_features_by_segment(_partners(spark, sf), FEATS, "Segment", 2.0, len(C.SEGMENT_LABELS) + 1)
    return explore.flag_breakdown(scored, "iqr_flag", "Segment", flagged_name="IQR_Flagged")


@register("detection_overlap", O.with_alerts(
    "SELECT count(*) FILTER (WHERE isolation_forest_flag AND iqr_flag) AS both, "
    "count(*) FILTER (WHERE isolation_forest_flag AND NOT iqr_flag) AS if_only, "
    "count(*) FILTER (WHERE NOT isolation_forest_flag AND iqr_flag) AS iqr_only, "
    "count(*) FILTER (WHERE NOT isolation_forest_flag AND NOT iqr_flag) AS neither FROM alerts"))
def q_detection_overlap(spark, sf):
    return explore.detection_overlap(FX.alert_stream(spark, sf))


@register("eda_summary", O.with_ledger(
    "SELECT * FROM (SELECT count(*) AS transactions, "
    f"{R('max(Amount)')} AS largest_amount, count(*) FILTER (WHERE Amount > 10000) AS over_10k, "
    "count(*) FILTER (WHERE Amount > 100000) AS over_100k, "
    f"{R(ZC_OVER_AC)} AS global_zc_ac_ratio, "
    f"{R('quantile_cont(Amount, 0.5)')} AS median_amount FROM sig2) "
    ", (SELECT count(*) AS partners, count(*) FILTER (WHERE ReversalRatio > 5) AS reversal_over_5x, "
    "count(*) FILTER (WHERE MaxSingleAmount > 100000) AS max_amount_over_100k, "
    "count(*) FILTER (WHERE TotalTransactions > (SELECT quantile_cont(TotalTransactions, 0.99) FROM raw_partners)) "
    f"AS top_1pct_volume, {R('max(ReversalRatio)')} AS max_reversal_ratio FROM raw_partners)"))
def q_eda_summary(spark, sf):
    return rounded(explore.eda_summary(_sig(spark, sf), _raw_partners(spark, sf)))


@register("amount_histogram", O.with_ledger(
    "SELECT CAST(b AS INTEGER) AS bin, " + R("lo + b * ((hi - lo) / 100.0)") + " AS bin_start, "
    + R("lo + (b + 1) * ((hi - lo) / 100.0)") + " AS bin_end, count(*) AS count FROM ("
    "SELECT CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((Amount - lo) * (100.0 / (hi - lo))), 99) END AS b, lo, hi "
    "FROM silver, (SELECT min(Amount) AS lo, max(Amount) AS hi FROM silver)) GROUP BY b, lo, hi"))
def q_amount_histogram(spark, sf):
    return rounded(explore.histogram(_silver(spark, sf), "Amount", 100))


_KDE_COL = "ReversalRatio"


@register("segment_density", O.with_ledger(
    f"SELECT Segment, point, {R('g0 + point * gstep', 9)} AS x, "
    f"{R('sum(exp(-0.5 * pow(((g0 + point * gstep) - x) / bw, 2))) / (n * bw * sqrt(2 * pi()))', 9)} AS density "
    "FROM (SELECT c.Segment, c.x, g.n, g.bw, g.g0, g.gstep, CAST(p.point AS INTEGER) AS point FROM clipped c "
    "JOIN g ON c.Segment = g.Segment, range(1000) p(point)) GROUP BY Segment, point, n, bw, g0, gstep",
    extra_ctes=(
        f"cap AS (SELECT Segment, quantile_cont({_KDE_COL}, 0.95) AS cap FROM partners GROUP BY Segment), "
        f"clipped AS (SELECT p.Segment, least(p.{_KDE_COL}, cap.cap) AS x FROM partners p JOIN cap USING (Segment)), "
        "gstat AS (SELECT Segment, count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM clipped "
        "GROUP BY Segment), "
        "g AS (SELECT Segment, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, mn - (mx - mn) * 0.5 AS g0, "
        "(mx - mn) * 2 / 999.0 AS gstep FROM gstat WHERE n >= 5 AND sd > 0)")))
def q_segment_density(spark, sf):
    d = explore.segment_density(_partners(spark, sf), _KDE_COL, "Segment", 0.95, 1000, 5, len(C.SEGMENT_LABELS) + 1)
    return d.select("Segment", "point", r("x", 9).alias("x"), r("density", 9).alias("density"))


@register("winsorize", O.with_ledger(
    "SELECT BusinessPartner, " + ", ".join(
        f"{R(f'least(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.99) FROM raw_partners))')} AS {c}"
        for c in EDA8) + " FROM raw_partners"))
def q_winsorize(spark, sf):
    w = peers.winsorize(_raw_partners(spark, sf), EDA8, 0.99)
    return rounded(w.select("BusinessPartner", *EDA8), money=set())


@register("standard_scale", O.with_ledger(
    "SELECT p.BusinessPartner, p.PeerGroup, " + ", ".join(
        R(f"(p.{c} - g.{c}__m) / CASE WHEN g.{c}__s = 0 THEN 1 ELSE g.{c}__s END") + f" AS {c}_scaled" for c in FEATS)
    + " FROM partners p JOIN (SELECT PeerGroup, " + ", ".join(
        f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in FEATS)
    + " FROM partners GROUP BY PeerGroup) g ON p.PeerGroup = g.PeerGroup"))
def q_standard_scale(spark, sf):
    s = peers.standard_scale(_partners(spark, sf), FEATS, "PeerGroup", C.peer_group_bound())
    return rounded(s.select("BusinessPartner", "PeerGroup", *[f"{c}_scaled" for c in FEATS]), money=set())


# ------------------------------------------------------------------ L1-L6, W4, J4, S8, L3
def _reason_sql(srr: float = 5.0, hbt: float = 100_000.0, hrs: float = 0.7) -> str:
    """Reason text in SQL from the same fixed templates as the Spark expression."""
    texts = []
    for c in FEATS:
        t = O.render_sql(alerts.feature_template(c), {
            "col": c, "value": O.Sql(c), "score": O.Sql(f"{c}_iqr_score"), "peer": O.Sql("PeerGroup"),
            "pct": O.Sql(f"CAST({c} AS DOUBLE) * 100"), "count": O.Sql(c)})
        texts.append(f"CASE WHEN list_contains(string_split(iqr_triggered_cols, ', '), '{c}') THEN {t} END")
    sep = alerts.REASON_SEPARATOR
    per = f"concat_ws('{sep}', " + ", ".join(texts) + ")"
    rules = [
        f"CASE WHEN ReversalRatio > {srr!r} AND NOT contains(iqr_triggered_cols, 'ReversalRatio') THEN "
        + O.render_sql(alerts.RULE_REVERSAL, {"value": O.Sql("ReversalRatio"), "limit": srr}) + " END",
        f"CASE WHEN AvgROSScore > {hrs!r} AND NOT contains(iqr_triggered_cols, 'AvgROSScore') THEN "
        + O.render_sql(alerts.RULE_ROS, {"value": O.Sql("AvgROSScore")}) + " END",
        f"CASE WHEN abs(Balance) > {hbt!r} THEN "
        + O.render_sql(alerts.RULE_BALANCE, {"value": O.Sql("Balance"), "limit": hbt}) + " END",
    ]
    return f"CASE WHEN iqr_flag THEN concat_ws('{sep}', NULLIF({per}, ''), {', '.join(rules)}) ELSE '' END"


@register("flag_reason", O.with_ledger(
    f"SELECT BusinessPartner, iqr_flag, {_reason_sql()} AS flag_reason FROM iqr", extra_ctes=O.iqr_cte()))
def q_flag_reason(spark, sf):
    s = peers.score_features_by_segment(_partners(spark, sf), FEATS, "PeerGroup", 2.0, C.peer_group_bound())
    s = s.withColumns({"isolation_forest_flag": F.lit(False), "risk_score": F.lit(0.0)})
    return alerts.build_alert_column(s).select("BusinessPartner", "iqr_flag", "flag_reason")


ALERT_COLS = ["BusinessPartner", "event_id", "isolation_forest_flag", "iqr_flag", "risk_score", "run_date",
              "Segment", "PeerGroup", "TotalAmount", "ReversalRatio", "MaxSingleAmount"]
_COOL = ("recent AS (SELECT DISTINCT BusinessPartner FROM history "
         "WHERE run_date >= DATE '2024-01-24' AND run_date < DATE '2024-01-31'), "
         "fresh AS (SELECT * FROM deduped WHERE BusinessPartner NOT IN (SELECT BusinessPartner FROM recent)), "
         "suppressed AS (SELECT * FROM deduped WHERE BusinessPartner IN (SELECT BusinessPartner FROM recent))")
_COOLDOWN_DAYS = 7


def _dedup_result(spark, sf):
    new = FX.alert_stream(spark, sf)
    hist = FX.alert_history(spark, sf)
    return alerts.run_full_deduplication(new, hist, FX.ALERTS_AS_OF, _COOLDOWN_DAYS, tie_col="event_id")


@register("dedup_within_run", O.with_alerts(f"SELECT {', '.join(ALERT_COLS)} FROM deduped"))
def q_dedup(spark, sf):
    return alerts.deduplicate_within_run(FX.alert_stream(spark, sf), tie_col="event_id")


@register("cooldown_fresh", O.with_alerts(f"SELECT {', '.join(ALERT_COLS)} FROM fresh", extra_ctes=_COOL))
def q_cooldown_fresh(spark, sf):
    return _dedup_result(spark, sf).fresh


@register("cooldown_suppressed", O.with_alerts(f"SELECT {', '.join(ALERT_COLS)} FROM suppressed", extra_ctes=_COOL))
def q_cooldown_suppressed(spark, sf):
    return _dedup_result(spark, sf).suppressed


HIST_COLS = ["BusinessPartner", "Segment", "PeerGroup", "risk_score", "isolation_forest_flag", "iqr_flag",
             "flag_reason", "TotalAmount", "ReversalRatio", "MaxSingleAmount", "run_date"]


@register("history_append", O.with_alerts(
    f"SELECT {', '.join(HIST_COLS)} FROM history UNION ALL "
    "SELECT BusinessPartner, Segment, PeerGroup, risk_score, isolation_forest_flag, iqr_flag, "
    "CAST(NULL AS VARCHAR) AS flag_reason, TotalAmount, ReversalRatio, MaxSingleAmount, DATE '2024-01-31' AS run_date "
    "FROM fresh", extra_ctes=_COOL))
def q_history_append(spark, sf):
    return _dedup_result(spark, sf).history.select(*HIST_COLS)


@register("history_rerun", O.with_alerts(
    "SELECT DISTINCT BusinessPartner, Segment, run_date FROM (SELECT BusinessPartner, Segment, "
    "DATE '2024-01-30' AS run_date FROM alerts WHERE Segment = 'error' UNION ALL SELECT BusinessPartner, Segment, "
    "DATE '2024-01-31' FROM alerts WHERE Segment = 'purchase' AND TotalAmount > 100)"))
def q_history_rerun(spark, sf):
    """One day written, the next written, rerun with fewer alerts, a third
    rerun with none; the log read back holds what the last run of each day left."""
    from datetime import date

    from partnerwatch.session import checkpoint_dir
    from partnerwatch.sources import files

    path = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/history-{uuid.uuid4().hex}"
    ev = FX.alert_stream(spark, sf).drop("run_date").dropDuplicates(["BusinessPartner", "Segment", "TotalAmount"])
    bought = ev.filter("Segment = 'purchase'")
    files.write_history(ev.filter("Segment = 'error'"), path, date(2024, 1, 30))
    files.write_history(bought, path, date(2024, 1, 31))
    files.write_history(bought.filter("TotalAmount > 100"), path, date(2024, 1, 31))
    files.write_history(bought, path, date(2024, 2, 1))
    files.write_history(bought.limit(0), path, date(2024, 2, 1))
    return files.read_history(spark, path).select("BusinessPartner", "Segment", "run_date").distinct()


@register("published_runs", O.with_alerts(
    f"SELECT {', '.join(HIST_COLS)} FROM (SELECT BusinessPartner, Segment, PeerGroup, risk_score, isolation_forest_flag, "
    "iqr_flag, CAST(NULL AS VARCHAR) AS flag_reason, TotalAmount, ReversalRatio, MaxSingleAmount, "
    "CASE Segment WHEN 'error' THEN DATE '2024-01-30' ELSE DATE '2024-01-31' END AS run_date FROM alerts "
    "WHERE Segment = 'error' OR (Segment = 'purchase' AND TotalAmount > 100))"))
def q_published_runs(spark, sf):
    """S5, S6, S8 as published runs: a day, the next day, that day again with fewer
    alerts, and a run of both that stops before it publishes; all columns of the log."""
    from datetime import date

    from partnerwatch.schemas import HISTORY_SCHEMA
    from partnerwatch.session import checkpoint_dir
    from partnerwatch.sources import files, publish

    base = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/published-{uuid.uuid4().hex}"
    ev = FX.alert_stream(spark, sf).drop("run_date")
    bought, days = ev.filter("Segment = 'purchase'"), (date(2024, 1, 30), date(2024, 1, 31))
    for rows, day, finished in ((ev.filter("Segment = 'error'"), days[0], True), (bought, days[1], True),
                                (bought.filter("TotalAmount > 100"), days[1], True), (ev, days[0], False)):
        run = publish.Run(base, f"alerts-{day.isoformat()}")
        run.write(files.history_rows(rows, day), "history", day.isoformat())
        run.write(rows, "watchlist", writer=files.write_watchlist)
        if finished:
            run.publish(spark)
    return publish.read(spark, base, "history", HISTORY_SCHEMA).select(*HIST_COLS)


@register("alert_summary", O.with_alerts(
    "SELECT (SELECT count(*) FROM deduped) AS total_flagged, (SELECT count(*) FROM fresh) AS fresh_alerts, "
    "(SELECT count(*) FROM suppressed) AS suppressed_alerts", extra_ctes=_COOL))
def q_alert_summary(spark, sf):
    return alerts.alert_summary(_dedup_result(spark, sf))


WATCH_COLS = [c for c in C.WATCHLIST_COLUMNS if c in ALERT_COLS]


@register("watchlist", O.with_alerts(
    f"SELECT {', '.join(WATCH_COLS)} FROM fresh", extra_ctes=_COOL))
def q_watchlist(spark, sf):
    return alerts.watchlist(_dedup_result(spark, sf).fresh)


for _key, _col in [("top_reversal", "ReversalRatio"), ("top_amount", "MaxSingleAmount"),
                   ("top_volume", "TotalTransactions")]:
    def _mk(col):
        def q(spark, sf):
            return rounded(alerts.show_top(_raw_partners(spark, sf), col, 12))
        return q
    _cols = list(dict.fromkeys(["BusinessPartner", "BusinessPartnerName", "Segment", _col, "TotalTransactions", "TotalAmount"]))
    _sel = ", ".join(R(c, 2 if c in MONEY_2DP else 6) + f" AS {c}"
                     if c in ("ReversalRatio", "MaxSingleAmount", "TotalAmount") else c for c in _cols)
    register(_key, O.with_ledger(
        f"SELECT {_sel} FROM raw_partners WHERE {_col} IS NOT NULL "
        f"ORDER BY {_col} DESC, BusinessPartner ASC LIMIT 12"))(_mk(_col))


@register("top_watchlist", O.with_alerts(
    "SELECT BusinessPartner, Segment, TotalAmount, MaxSingleAmount, ReversalRatio, risk_score, "
    "CASE WHEN isolation_forest_flag THEN 'YES' ELSE 'no' END AS IF, CASE WHEN iqr_flag THEN 'YES' ELSE 'no' END AS IQR "
    "FROM deduped WHERE isolation_forest_flag OR iqr_flag ORDER BY risk_score DESC, BusinessPartner LIMIT 20"))
def q_top_watchlist(spark, sf):
    return alerts.top_watchlist(alerts.deduplicate_within_run(FX.alert_stream(spark, sf), tie_col="event_id"), 20)


# ------------------------------------------------------------------ M1-M6
TH = C.DEFAULTS.scoring


GROUP_BOUNDS = {"PeerGroup": C.peer_group_bound(), "Segment": len(C.SEGMENT_LABELS) + 1}


def _rounded_partners(spark, sf):
    """The partner table with model features of six decimals, so that both engines
    grow the forest from the same numbers."""
    p = _partners(spark, sf)
    return p.withColumns({c: r(c) for c in FEATS})


def _gold_if(spark, sf, segment_col="PeerGroup", min_size=TH.smallest_group):
    p = _rounded_partners(spark, sf)
    return iforest.run_isolation_forest_by_segment(
        p, FEATS, segment_col, TH.contamination, TH.trees,
        TH.seed, min_size, group_bound=GROUP_BOUNDS[segment_col])


def _forest_sql(group: str | None, trees: int, contaminations: tuple[float, ...], body: str) -> str:
    grown = O.forest_ctes(tuple(FEATS), R, group, trees, TH.seed, TH.smallest_group)
    return O.with_ledger(body, extra_ctes=f"{grown},{O.forest_offsets(contaminations)}")


_IF_VALUES = ("SELECT r.partner, s.score - o.offset_ AS value FROM if_route r JOIN if_scores s ON s.partner = r.partner "
              "AND s.model = r.model JOIN if_offset o ON o.model = s.model")


@register("if_scores", _forest_sql("PeerGroup", TH.trees, (TH.contamination,), (
    f"SELECT BusinessPartner, PeerGroup, {R('value', 9)} AS isolation_forest_score, value < 0 AS isolation_forest_flag, "
    + R("1 - (value - min(value) OVER ()) / CASE WHEN max(value) OVER () <> min(value) OVER () "
        "THEN max(value) OVER () - min(value) OVER () ELSE 1 END", 9)
    + f" AS risk_score FROM partners JOIN ({_IF_VALUES}) ON partner = BusinessPartner")))
def q_if_scores(spark, sf):
    """M2-M5: scores, flags and risk, against the same forest grown level by level in SQL."""
    g = _gold_if(spark, sf)
    return g.select("BusinessPartner", "PeerGroup", r("isolation_forest_score", 9).alias("isolation_forest_score"),
                    "isolation_forest_flag", r("risk_score", 9).alias("risk_score"))


@register("if_score_range", O.with_ledger(
    "SELECT count(*) AS partners, 0.0 AS risk_min, 1.0 AS risk_max, count(*) AS in_range FROM partners"))
def q_if_score_range(spark, sf):
    g = _gold_if(spark, sf)
    return g.agg(F.count(F.lit(1)).alias("partners"), r(F.min("risk_score"), 9).alias("risk_min"),
                 r(F.max("risk_score"), 9).alias("risk_max"),
                 F.count_if(F.col("risk_score").between(0.0, 1.0)).alias("in_range"))


def _expected_flags(n: str, c: float) -> str:
    return f"CAST(ceil(round({c!r} * ({n} - 1), 9)) AS BIGINT)"


@register("if_flag_counts", O.with_ledger(
    f"SELECT PeerGroup AS model_key, count(*) AS n_train, {_expected_flags('count(*)', 0.05)} AS flagged "
    "FROM partners GROUP BY PeerGroup"))
def q_if_flag_counts(spark, sf):
    return iforest.flag_counts(_partners(spark, sf), FEATS, "PeerGroup", TH.contamination,
                               TH.trees, TH.seed,
                               TH.smallest_group, group_bound=C.peer_group_bound())


_ROUTE_MIN = 60


@register("if_routing", O.with_ledger(
    f"SELECT BusinessPartner, CASE WHEN count(*) OVER (PARTITION BY PeerGroup) >= {_ROUTE_MIN} THEN PeerGroup "
    f"ELSE '{C.GLOBAL_MODEL_KEY}' END AS model_key FROM partners"))
def q_if_routing(spark, sf):
    return iforest.model_routing(_partners(spark, sf), "PeerGroup", _ROUTE_MIN)


@register("if_breakdown", O.with_ledger(
    f"SELECT Segment, count(*) AS Partners, {_expected_flags('count(*)', 0.05)} AS IF_Flagged, "
    f"round_even({_expected_flags('count(*)', 0.05)} / count(*) * 100 * 10.0, 0) / 10.0 AS PctFlagged "
    "FROM partners GROUP BY Segment"))
def q_if_breakdown(spark, sf):
    g = _gold_if(spark, sf, "Segment")
    return explore.flag_breakdown(g, "isolation_forest_flag", "Segment", flagged_name="IF_Flagged")


SWEEP = (0.01, 0.02, 0.05, 0.10, 0.15)


ZS = [f"{c}_zscore" for c in Z_COLS]
IQRS = [f"{c}_iqr_score" for c in FEATS]
GOLD_TAIL = ["iqr_max_score", "iqr_flag", "iqr_triggered_cols", "isolation_forest_score", "isolation_forest_flag",
             "risk_score", "flag_reason"]


def _gold_sql() -> str:
    """CTE ``gold``: the partner table with every score, flag and reason."""
    z = ", ".join(f"(p.{c} - avg(p.{c}) OVER w) / CASE WHEN stddev_samp(p.{c}) OVER w = 0 THEN 1 ELSE stddev_samp(p.{c}) OVER w END "
                  f"AS {c}_zscore" for c in Z_COLS)
    risk = ("1 - (value - min(value) OVER ()) / CASE WHEN max(value) OVER () <> min(value) OVER () "
            "THEN max(value) OVER () - min(value) OVER () ELSE 1 END")
    reason = _reason_sql().removeprefix("CASE WHEN iqr_flag THEN ").removesuffix(" ELSE '' END")
    only = O.render_sql(alerts.IF_ONLY, {"peer": O.Sql("PeerGroup"), "risk": O.Sql("risk_score")})
    return (O.iqr_cte() + "," + O.forest_ctes(tuple(FEATS), R, "PeerGroup", TH.trees, TH.seed, TH.smallest_group)
            + f",{O.forest_offsets((TH.contamination,))}, "
            f"if_value AS ({_IF_VALUES}), "
            f"scored AS (SELECT i.*, {', '.join(ZS)}, value AS isolation_forest_score, value < 0 AS isolation_forest_flag, "
            f"{risk} AS risk_score FROM iqr i JOIN (SELECT BusinessPartner, {z} FROM partners p WINDOW w AS (PARTITION BY PeerGroup)) zs "
            "ON zs.BusinessPartner = i.BusinessPartner JOIN if_value ON partner = i.BusinessPartner), "
            f"reasoned AS (SELECT *, {reason} AS told FROM scored), "
            f"gold AS (SELECT *, CASE WHEN NOT (iqr_flag OR isolation_forest_flag) THEN '' WHEN told = '' AND isolation_forest_flag "
            f"THEN {only} ELSE told END AS flag_reason FROM reasoned)")


def _gold(spark, sf):
    """Gold over partners with rounded features, so that both engines see the same numbers."""
    p = P.fixture_partners(spark, sf)
    return P.score_partners(p.withColumns({c: r(c) for c in FEATS}))


_GOLD_SOURCE = O.ledger_ctes().replace("\npartners AS (", "\nexact_partners AS (", 1).replace("raw_partners AS (", "raw_partners AS (") + (
    ",\npartners AS (SELECT * REPLACE (" + ", ".join(f"{R(c)} AS {c}" for c in FEATS) + ") FROM exact_partners)")


def _with_gold(body: str) -> str:
    return f"WITH {_GOLD_SOURCE},\n{_gold_sql()}\n{body}"


GOLD_DOUBLES = {*ROLLUP_DOUBLES, *FEATS, *ZS, *IQRS, "iqr_max_score", "isolation_forest_score", "risk_score"}


def _gold_select(cols: list[str], rank: str = "") -> str:
    return ", ".join(f"{R(f'CAST({c} AS DOUBLE)', 2 if c in MONEY_2DP else 6)} AS {c}" if c in GOLD_DOUBLES else c for c in cols) + rank


def _gold_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[r(F.col(c).cast("double"), 2 if c in MONEY_2DP else 6).alias(c) if c in GOLD_DOUBLES else F.col(c) for c in cols])


GOLD_COLS = [*ROLLUP_COLS, *ZS, *IQRS, *GOLD_TAIL]


@register("gold", _with_gold(f"SELECT {_gold_select(GOLD_COLS)} FROM gold"))
def q_gold(spark, sf):
    """All 64 columns of the gold table."""
    g = _gold(spark, sf)
    assert set(g.columns) == set(GOLD_COLS), sorted(set(g.columns) ^ set(GOLD_COLS))
    return _gold_columns(g, GOLD_COLS)


WATCH20 = list(C.WATCHLIST_COLUMNS)
_RANK = "CAST(row_number() OVER (ORDER BY risk_score DESC NULLS LAST, BusinessPartner) AS BIGINT)"


@register("watchlist_ranked", _with_gold(
    f"SELECT {_gold_select(WATCH20)}, rank FROM (SELECT *, {_RANK} AS rank FROM gold WHERE iqr_flag OR isolation_forest_flag)"))
def q_watchlist_ranked(spark, sf):
    """All 20 columns and the order of the watchlist file, read back."""
    from partnerwatch.session import checkpoint_dir
    from partnerwatch.sources import files

    path = f"{checkpoint_dir(spark).rstrip('/')}/partnerwatch/watchlist-{uuid.uuid4().hex}"
    g = _gold(spark, sf)
    listed = alerts.watchlist(g.filter(F.col("iqr_flag") | F.col("isolation_forest_flag")))
    files.write_watchlist(listed, path)
    return _gold_columns(files.read_watchlist(spark, path, listed.schema), WATCH20 + ["rank"])


@register("if_flags_by_segment", _forest_sql("Segment", TH.trees, (TH.contamination,), (
    f"SELECT BusinessPartner, Segment, value < 0 AS isolation_forest_flag, {R('value', 9)} AS isolation_forest_score "
    f"FROM partners JOIN ({_IF_VALUES}) ON partner = BusinessPartner")))
def q_if_flags_by_segment(spark, sf):
    """M4 by partner: groups larger than a tree's sample."""
    return _gold_if(spark, sf, "Segment").select("BusinessPartner", "Segment", "isolation_forest_flag",
                                                 r("isolation_forest_score", 9).alias("isolation_forest_score"))


@register("contamination_flags", _forest_sql(None, 100, SWEEP, (
    "SELECT partner AS BusinessPartner, contamination, score < offset_ AS flagged "
    "FROM if_scores s JOIN if_offset o ON o.model = s.model")))
def q_contamination_flags(spark, sf):
    """M6 by partner: who is flagged at each contamination."""
    return iforest.contamination_flags(_rounded_partners(spark, sf), FEATS, SWEEP, 100, TH.seed)


@register("contamination_sweep", O.with_ledger(
    " UNION ALL ".join(
        f"SELECT CAST({c!r} AS DOUBLE) AS contamination, {_expected_flags('count(*)', c)} AS flagged, "
        f"{R(_expected_flags('count(*)', c) + ' / count(*) * 100')} AS pct FROM partners" for c in SWEEP)))
def q_contamination_sweep(spark, sf):
    s = iforest.contamination_sweep(_partners(spark, sf), FEATS, SWEEP, 100, TH.seed)
    return s.select("contamination", "flagged", r("pct").alias("pct"))


@register("risk_score", O.with_alerts(
    f"SELECT event_id, {R('1 - (TotalAmount - mn) / CASE WHEN mx <> mn THEN mx - mn ELSE 1 END', 9)} AS risk_score "
    "FROM alerts, (SELECT min(TotalAmount) AS mn, max(TotalAmount) AS mx FROM alerts)"))
def q_risk_score(spark, sf):
    a = FX.alert_stream(spark, sf).select("event_id", F.col("TotalAmount").alias("score"))
    return iforest.risk_from_scores(a, "score").select("event_id", r("risk_score", 9).alias("risk_score"))


# ------------------------------------------------------------------ S1

ORDER_RECORD = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.StringType()), T.StructField("o_orderpriority", T.StringType()),
])
PAGE_SIZE = 500


def order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Captured-page stand-in: ``orders`` grouped into pages of PAGE_SIZE records
    (bounded per page), each rendered as an OData JSON envelope."""
    o = FX.table(spark, sf, "orders")
    rec = F.struct(
        F.struct(F.concat(F.lit("Orders("), F.col("o_orderkey").cast("string"), F.lit(")")).alias("uri")).alias("__metadata"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.concat(F.lit("/Date("), F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"),
                 F.lit(")/")).alias("o_orderdate"),
        "o_orderpriority")
    page = F.floor(F.col("o_orderkey") / PAGE_SIZE)
    pages = o.groupBy(page.alias("page")).agg(F.collect_list(rec).alias("results"))
    nxt = F.concat(F.lit("Orders?$skiptoken="), (F.col("page") + 1).cast("string"))
    return pages.select(F.to_json(F.struct(F.struct("results", nxt.alias("__next")).alias("d"))).alias("body"))


@register("odata_land",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
          "'/Date(' || CAST(epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS VARCHAR) || ')/' AS o_orderdate, "
          "o_orderpriority FROM orders")
def q_odata_land(spark, sf):
    return odata.parse_pages(order_pages(spark, sf), "body", ORDER_RECORD)


_FILTER = ("o_totalprice gt 100000M and (startswith(o_orderpriority, '1') or o_orderstatus eq 'F') "
           "and not (o_orderdate lt datetime'1995-01-01T00:00:00') and length(o_orderstatus) le 1 and o_custkey ne null")


@register("odata_filter",
          "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 100000 "
          "AND (o_orderpriority LIKE '1%' OR o_orderstatus = 'F') AND CAST(o_orderdate AS TIMESTAMP) >= TIMESTAMP '1995-01-01' "
          "AND length(o_orderstatus) <= 1 AND o_custkey IS NOT NULL")
def q_odata_filter(spark, sf):
    """Pages landed through the service's own ``$filter`` text."""
    rows = odata.parse_pages(order_pages(spark, sf), "body", ORDER_RECORD, odata_filter=_FILTER)
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


_CHAIN_SQL = """
WITH RECURSIVE made AS (
  SELECT o_orderpriority AS entity, o_orderkey // 500 AS page FROM orders GROUP BY ALL
), captured AS (
  SELECT entity || '?$skiptoken=' || page AS url, entity || '?$skiptoken=' || (page + 1) AS next, copies
  FROM (SELECT *, CASE WHEN (page + ascii(entity)) % 37 = 5 THEN 0 WHEN page % 11 = 3 THEN 2 ELSE 1 END AS copies FROM made) WHERE copies > 0
), reached AS (
  SELECT DISTINCT entity || '?$skiptoken=' || first AS chain, entity || '?$skiptoken=' || first AS url, 0::BIGINT AS position
  FROM made, (VALUES (0), (40)) s(first)
  UNION ALL
  SELECT chain, c.next, position + 1 FROM reached r JOIN captured c ON c.url = r.url
)
SELECT coalesce(r.url, c.url) AS url, chain, position,
       CASE WHEN c.url IS NULL THEN 'missing' WHEN chain IS NULL THEN 'unreachable' WHEN copies > 1 THEN 'doubled' ELSE 'ok' END AS status
FROM reached r FULL JOIN captured c ON c.url = r.url
"""


@register("odata_chain", _CHAIN_SQL)
def q_odata_chain(spark, sf):
    """The captured pages of five entity sets, some missing and some captured
    twice, checked along their ``__next`` links from two starts each."""
    o = FX.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("entity"), F.floor(F.col("o_orderkey") / 500).alias("page"))
    page = o.groupBy("entity", "page").agg(F.count(F.lit(1)).alias("n"))
    at = lambda p: F.concat("entity", F.lit("?$skiptoken="), p.cast("string"))
    copies = F.when((F.col("page") + F.ascii("entity")) % 37 == 5, 0).when(F.col("page") % 11 == 3, 2).otherwise(1)
    body = F.to_json(F.struct(F.struct(F.array_repeat(F.lit("{}"), F.col("n").cast("int")).alias("results"),
                                       at(F.col("page") + 1).alias("__next")).alias("d")))
    pages = page.select(at(F.col("page")).alias("url"), body.alias("body"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_c"))
    firsts = page.select("entity", F.explode(F.array(F.lit(0), F.lit(40))).alias("first")).distinct()
    starts = firsts.select(at(F.col("first")).alias("url"))
    return odata.check_chains(odata.page_links(pages, "url", "body"), starts)


# ------------------------------------------------------------------ variants: W5 per group / fixed, L6, H1
@register("winsorize_by_segment", O.with_ledger(
    "SELECT r.BusinessPartner, r.Segment, " + ", ".join(
        f"{R(f'least(CAST(r.{c} AS DOUBLE), q.{c}__cap)')} AS {c}" for c in ("TotalAmount", "ReversalRatio",
                                                                                "TotalTransactions"))
    + " FROM raw_partners r JOIN (SELECT Segment, " + ", ".join(
        f"quantile_cont({c}, 0.95) AS {c}__cap" for c in ("TotalAmount", "ReversalRatio", "TotalTransactions"))
    + " FROM raw_partners GROUP BY Segment) q ON r.Segment = q.Segment"))
def q_winsorize_by_segment(spark, sf):
    cols = ["TotalAmount", "ReversalRatio", "TotalTransactions"]
    w = peers.winsorize(_raw_partners(spark, sf), cols, 0.95, "Segment", len(C.SEGMENT_LABELS) + 1)
    return rounded(w.select("BusinessPartner", "Segment", *cols), money=set())


_CLIP_FEATS = ["ReversalRatio", "TotalAmount", "MaxSingleAmount", "TotalTransactions"]


@register("iqr_score_clip", O.with_ledger(
    "SELECT BusinessPartner, " + ", ".join(
        f"{R(f'least(greatest({c}_iqr_score, -3.0), 10.0)')} AS {c}_iqr_score" for c in _CLIP_FEATS)
    + " FROM iqr", extra_ctes=O.iqr_cte(group="Segment")))
def q_iqr_score_clip(spark, sf):
    s = peers.score_features_by_segment(_partners(spark, sf), FEATS, "Segment", 2.0, len(C.SEGMENT_LABELS) + 1)
    cols = [f"{c}_iqr_score" for c in _CLIP_FEATS]
    c = peers.clip_range(s, cols, -3.0, 10.0)
    return c.select("BusinessPartner", *[r(x).alias(x) for x in cols])


@register("sample_reasons", O.with_ledger(
    f"SELECT BusinessPartner, BusinessPartnerName, Segment, 0.0 AS risk_score, {_reason_sql()} AS flag_reason "
    "FROM iqr WHERE iqr_flag ORDER BY BusinessPartner LIMIT 10", extra_ctes=O.iqr_cte()))
def q_sample_reasons(spark, sf):
    s = peers.score_features_by_segment(_partners(spark, sf), FEATS, "PeerGroup", 2.0, C.peer_group_bound())
    s = alerts.build_alert_column(s.withColumns({"isolation_forest_flag": F.lit(False), "risk_score": F.lit(0.0)}))
    return alerts.sample_reasons(s, 10)


@register("amount_histogram_under_10k", O.with_ledger(
    "SELECT CAST(b AS INTEGER) AS bin, " + R("lo + b * ((hi - lo) / 100.0)") + " AS bin_start, "
    + R("lo + (b + 1) * ((hi - lo) / 100.0)") + " AS bin_end, count(*) AS count FROM ("
    "SELECT CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((Amount - lo) * (100.0 / (hi - lo))), 99) END AS b, lo, hi "
    "FROM (SELECT Amount FROM silver WHERE Amount < 10000), "
    "(SELECT min(Amount) AS lo, max(Amount) AS hi FROM silver WHERE Amount < 10000)) GROUP BY b, lo, hi"))
def q_amount_histogram_under_10k(spark, sf):
    return rounded(explore.histogram(_silver(spark, sf), "Amount", 100, upper_exclusive=10_000.0))


@register("flag_reason_alerts", O.with_alerts(
    "SELECT event_id, CASE WHEN isolation_forest_flag OR iqr_flag THEN "
    "CASE WHEN ReversalRatio > 5.0 THEN "
    + O.render_sql(alerts.RULE_REVERSAL, {"value": O.Sql("ReversalRatio"), "limit": 5.0})
    + " WHEN isolation_forest_flag THEN "
    + O.render_sql(alerts.IF_ONLY, {"peer": O.Sql("PeerGroup"), "risk": O.Sql("risk_score")})
    + " ELSE '' END ELSE '' END AS flag_reason FROM alerts"))
def q_flag_reason_alerts(spark, sf):
    """L1/L2 on the alert fixture: exercises the reversal rule and the IF-only fallback."""
    return alerts.build_alert_column(FX.alert_stream(spark, sf)).select("event_id", "flag_reason")
