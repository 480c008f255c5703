"""DuckDB SQL oracles for the driver's correctness gate.

The SQL is an independent formulation of each query over the same parquet
views; literals are rendered from the same fixed constants as the Spark code so
both sides use bit-identical parameters.
"""

from __future__ import annotations

from partnerwatch import config as C
from partnerwatch.sources import fixtures as FX


def _case(col: str, mapping: dict[str, str], default: str | None) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {col} {whens}{tail} END"


def _lit(x: float) -> str:
    return repr(float(x))


def ledger_ctes(as_of: str = "DATE '2002-01-01'") -> str:
    """CTEs: silver (typed ledger), tx (signals + netting), partners (rollup + PeerGroup)."""
    ros = ", ".join(
        f"exp(-0.5 * pow((Amount - {_lit(L)}) / {_lit(C.ROS_BANDWIDTH * L)}, 2))" for L in C.AUTHORITY_LIMITS)
    rounds = ", ".join(
        f"CASE WHEN fmod(Amount, {_lit(t)}) = 0 AND Amount > 0 THEN 1 ELSE 0 END AS IsRound{t}"
        for t in C.ROUND_THRESHOLDS)
    round_any = "greatest(" + ", ".join(f"IsRound{t}" for t in C.ROUND_THRESHOLDS) + ")"
    docnum = (
        "format('{:019d}-{:019d}-{:019d}-{:019d}-{:019d}', l_orderkey::BIGINT, l_linenumber::BIGINT, l_partkey::BIGINT, "
        "l_suppkey::BIGINT, CAST(round(l_extendedprice * 100) AS BIGINT))"
    )
    return f"""
silver AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS BusinessPartner,
         c.c_name AS BusinessPartnerName,
         CAST(NULL AS VARCHAR) AS FirstName, CAST(NULL AS VARCHAR) AS LastName,
         CAST(NULL AS VARCHAR) AS PostalCode, CAST(NULL AS VARCHAR) AS CompanyCode,
         CAST(l.l_suppkey AS VARCHAR) AS ContractAccount,
         {docnum} AS CADocumentNumber,
         {_case('l_returnflag', FX.RETURN_FLAG_TO_DOC_TYPE, None)} AS CADocumentType,
         {_case('o_orderpriority', FX.ORDER_PRIORITY_TO_MAIN_TXN, 'ZZZZ')} AS CAMainTransaction,
         CAST(NULL AS VARCHAR) AS CASubTransaction,
         {_case('c_mktsegment', FX.MARKET_SEGMENT_TO_CODE, 'Z9')} AS CAAccountDeterminationCode,
         abs(CASE l_returnflag WHEN 'N' THEN l_extendedprice WHEN 'R' THEN l_quantity * 12.5
                               WHEN 'A' THEN -(l_quantity * 12.5) END) AS Amount,
         o_totalprice AS Balance, c_acctbal AS TotalDebit, l_extendedprice * l_discount AS TotalCredit,
         CAST(l_quantity AS INTEGER) AS NumberOfItems,
         CAST(l_shipdate AS TIMESTAMP) AS NetDueDate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
),
sig AS (
  SELECT *,
         CAST(date_diff('day', CAST(NetDueDate AS DATE), {as_of}) AS INTEGER) AS DaysOverdue,
         CASE WHEN CADocumentType = 'AC' THEN 1 ELSE 0 END AS ACDocCount,
         CASE WHEN CADocumentType = 'ZC' THEN 1 ELSE 0 END AS ZCDocCount,
         CASE WHEN Amount > {_lit(10000)} THEN 1 ELSE 0 END AS IsHighValue,
         CASE WHEN Amount > {_lit(100000)} THEN 1 ELSE 0 END AS IsExtremeValue,
         greatest(0.0, {ros}) AS ROSScore,
         {rounds},
         {_case('CAAccountDeterminationCode', C.SEGMENT_LABELS, C.SEGMENT_DEFAULT)} AS Segment,
         {_case('CAMainTransaction', C.TRANSACTION_TYPE_LABELS, C.TRANSACTION_TYPE_DEFAULT)} AS TransactionType
  FROM silver WHERE Amount IS NOT NULL AND BusinessPartner IS NOT NULL
),
sig2 AS (SELECT *, {round_any} AS IsRoundAny FROM sig),
pairkeys AS (
  SELECT BusinessPartner, round_even(Amount, 2) AS k FROM sig2
  WHERE CADocumentType IN ('AC', 'ZC')
  GROUP BY 1, 2 HAVING bool_or(CADocumentType = 'AC') AND bool_or(CADocumentType = 'ZC')
),
tx AS (
  SELECT s.*, CASE WHEN s.CADocumentType IN ('AC', 'ZC') AND p.k IS NOT NULL THEN 1 ELSE 0 END AS IsNetted
  FROM sig2 s LEFT JOIN pairkeys p ON s.BusinessPartner = p.BusinessPartner AND round_even(s.Amount, 2) = p.k
),
rollup AS (
  SELECT BusinessPartner,
    arg_min(BusinessPartnerName, CADocumentNumber) FILTER (WHERE IsNetted = 0 AND BusinessPartnerName IS NOT NULL) AS BusinessPartnerName,
    arg_min(Segment, CADocumentNumber) FILTER (WHERE IsNetted = 0 AND Segment IS NOT NULL) AS Segment,
    arg_min(TransactionType, CADocumentNumber) FILTER (WHERE IsNetted = 0 AND TransactionType IS NOT NULL) AS TransactionType,
    count(Amount) FILTER (WHERE IsNetted = 0) AS TotalTransactions,
    coalesce(CAST(sum(CAST(Amount AS DECIMAL(38,6))) FILTER (WHERE IsNetted = 0) AS DOUBLE), 0) AS TotalAmount,
    coalesce(CAST(sum(CAST(Amount AS DECIMAL(38,6))) FILTER (WHERE IsNetted = 0) AS DOUBLE)
             / count(Amount) FILTER (WHERE IsNetted = 0), 0) AS AvgAmount,
    coalesce(stddev_samp(Amount) FILTER (WHERE IsNetted = 0), 0) AS StdAmount,
    coalesce(max(Amount) FILTER (WHERE IsNetted = 0), 0) AS MaxSingleAmount,
    CAST(coalesce(sum(NumberOfItems) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS TotalItems,
    count(DISTINCT CADocumentType) FILTER (WHERE IsNetted = 0) AS UniqueDocTypes,
    count(DISTINCT CAMainTransaction) FILTER (WHERE IsNetted = 0) AS UniqueMainTransactions,
    count(DISTINCT ContractAccount) FILTER (WHERE IsNetted = 0) AS UniqueContracts,
    CAST(coalesce(sum(ACDocCount) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS ACDocCount,
    CAST(coalesce(sum(ZCDocCount) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS ZCDocCount,
    CAST(coalesce(sum(IsHighValue) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS HighValueCount,
    CAST(coalesce(sum(IsExtremeValue) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS ExtremeValueCount,
    coalesce(max(Balance) FILTER (WHERE IsNetted = 0), 0) AS Balance,
    coalesce(max(TotalDebit) FILTER (WHERE IsNetted = 0), 0) AS TotalDebit,
    coalesce(max(TotalCredit) FILTER (WHERE IsNetted = 0), 0) AS TotalCredit,
    coalesce(avg(DaysOverdue) FILTER (WHERE IsNetted = 0), 0) AS AvgDaysOverdue,
    coalesce(max(DaysOverdue) FILTER (WHERE IsNetted = 0), 0) AS MaxDaysOverdue,
    coalesce(avg(ROSScore) FILTER (WHERE IsNetted = 0), 0) AS AvgROSScore,
    coalesce(max(ROSScore) FILTER (WHERE IsNetted = 0), 0) AS MaxROSScore,
    CAST(coalesce(sum(IsRoundAny) FILTER (WHERE IsNetted = 0), 0) AS BIGINT) AS RoundTransactionCount,
    count(*) FILTER (WHERE IsNetted = 1) AS NettedPairsCount
  FROM tx GROUP BY BusinessPartner
),
partners AS (
  SELECT * EXCLUDE (NettedPairsCount),
         ZCDocCount / (ACDocCount + 1) AS ReversalRatio,
         StdAmount / (AvgAmount + 1) AS AmountVolatility,
         RoundTransactionCount / (TotalTransactions + 1) AS RoundTransactionRate,
         NettedPairsCount,
         Segment || '_' || TransactionType AS PeerGroup
  FROM rollup WHERE TotalTransactions > 0
),
raw_partners AS (
  SELECT BusinessPartner,
    arg_min(BusinessPartnerName, CADocumentNumber) FILTER (WHERE BusinessPartnerName IS NOT NULL) AS BusinessPartnerName,
    arg_min(Segment, CADocumentNumber) FILTER (WHERE Segment IS NOT NULL) AS Segment,
    count(Amount) AS TotalTransactions, CAST(sum(CAST(Amount AS DECIMAL(38,6))) AS DOUBLE) AS TotalAmount,
    CAST(sum(CAST(Amount AS DECIMAL(38,6))) AS DOUBLE) / count(Amount) AS AvgAmount,
    coalesce(stddev_samp(Amount), 0) AS StdAmount, max(Amount) AS MaxSingleAmount,
    CAST(sum(ACDocCount) AS BIGINT) AS ACDocCount, CAST(sum(ZCDocCount) AS BIGINT) AS ZCDocCount,
    CAST(sum(IsHighValue) AS BIGINT) AS HighValueCount, CAST(sum(IsExtremeValue) AS BIGINT) AS ExtremeValueCount,
    max(Balance) AS Balance, max(TotalDebit) AS TotalDebit,
    sum(ZCDocCount) / (sum(ACDocCount) + 1) AS ReversalRatio,
    coalesce(stddev_samp(Amount), 0) / (CAST(sum(CAST(Amount AS DECIMAL(38,6))) AS DOUBLE) / count(Amount) + 1)
      AS AmountVolatility
  FROM sig2 GROUP BY BusinessPartner
)"""


class Sql(str):
    """A SQL expression (as opposed to a plan-time Python value) for ``render_sql``."""


def render_sql(template: str, values: dict) -> str:
    """DuckDB twin of ``operators.alerts.render``: the same reason template as a
    SQL string expression (``format`` agrees with Python's format spec)."""
    import re

    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)(?::([^}]*))?\}", template):
        if m.start() > pos:
            parts.append("'" + template[pos:m.start()].replace("'", "''") + "'")
        name, spec = m.group(1), m.group(2) or ""
        v = values[name]
        if isinstance(v, Sql):
            if not spec:
                parts.append(str(v))
            elif spec == ",":
                parts.append(f"format('{{:,}}', CAST({v} AS BIGINT))")
            else:
                parts.append(f"format('{{:{spec}}}', CAST({v} AS DOUBLE))")
        else:
            parts.append("'" + (format(v, spec) if spec else str(v)).replace("'", "''") + "'")
        pos = m.end()
    if pos < len(template):
        parts.append("'" + template[pos:].replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def with_ledger(body: str, as_of: str = "DATE '2002-01-01'", extra_ctes: str = "") -> str:
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {ledger_ctes(as_of)}{extra}\n{body}"


def iqr_cte(source: str = "partners", group: str = "PeerGroup",
            features: tuple[str, ...] = C.MODEL_FEATURES, m: float = 2.0) -> str:
    """CTE ``iqr``: source rows + ``{f}_iqr_score``, ``iqr_max_score``, ``iqr_flag``, ``iqr_triggered_cols``."""
    q = ", ".join(
        f"quantile_cont({f}, 0.25) AS {f}__q1, quantile_cont({f}, 0.75) AS {f}__q3" for f in features)
    scores = ", ".join(
        f"CASE WHEN (q.{f}__q3 - q.{f}__q1) = 0 THEN 0.0 "
        f"ELSE (s.{f} - q.{f}__q3) / (q.{f}__q3 - q.{f}__q1) END AS {f}_iqr_score" for f in features)
    gmax = "greatest(" + ", ".join(f"{f}_iqr_score" for f in features) + ")"
    trig = "concat_ws(', ', " + ", ".join(
        f"CASE WHEN {f}_iqr_score > {_lit(m)} THEN '{f}' END" for f in features) + ")"
    join = f"ON s.{group} = q.{group}" if group else "ON TRUE"
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    return f"""
iqr_q AS (SELECT {gsel}{q} FROM {source} {gby}),
iqr_s AS (SELECT s.*, {scores} FROM {source} s JOIN iqr_q q {join}),
iqr AS (SELECT *, {gmax} AS iqr_max_score, coalesce({gmax} > {_lit(m)}, FALSE) AS iqr_flag,
               {trig} AS iqr_triggered_cols FROM iqr_s)"""


def alerts_ctes() -> str:
    """CTEs: alerts (event fixture), history (fixture), deduped (one row per partner)."""
    return """
alerts AS (
  SELECT CAST(user_id AS VARCHAR) AS BusinessPartner, event_id,
         event_type IN ('error', 'click') AS isolation_forest_flag,
         event_type IN ('error', 'purchase') AS iqr_flag,
         value / 1000.0 AS risk_score, CAST(ts AS DATE) AS run_date,
         event_type AS Segment, event_type || '_Events' AS PeerGroup,
         value AS TotalAmount, value / 100.0 AS ReversalRatio, value AS MaxSingleAmount
  FROM events
),
history AS (
  SELECT BusinessPartner, Segment, PeerGroup, risk_score, isolation_forest_flag, iqr_flag,
         'history' AS flag_reason, TotalAmount, ReversalRatio, MaxSingleAmount, run_date
  FROM alerts WHERE Segment = 'error' AND TotalAmount > 150
),
deduped AS (
  SELECT * FROM alerts
  QUALIFY row_number() OVER (
    PARTITION BY BusinessPartner
    ORDER BY CASE WHEN isolation_forest_flag AND iqr_flag THEN 3 WHEN iqr_flag THEN 2
                  WHEN isolation_forest_flag THEN 1 ELSE 0 END DESC,
             risk_score DESC NULLS LAST, event_id) = 1
)"""


def with_alerts(body: str, extra_ctes: str = "") -> str:
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {alerts_ctes()}{extra}\n{body}"


def forest_ctes(features: tuple[str, ...], value, group: str | None, trees: int, seed: int, min_size: int = 10,
                max_samples: int = 256, source: str = "partners") -> str:
    """CTEs that grow the counter-based Isolation Forest and score with it:
    ``if_scores`` (model, partner, score) of every member of every model and
    ``if_route`` (partner, model). One relation a level: ``if_r{d}`` holds every
    member of every tree with its node, ``if_n{d}`` the cut of every node.
    ``value`` renders a feature's SQL."""
    from partnerwatch.operators.iforest import PRIME, UNIT, lanes, max_depth

    k = len(features)
    xs = [f"x{i}" for i in range(k)]
    flat = ", ".join(f"coalesce(CASE WHEN NOT isnan(CAST({value(c)} AS DOUBLE)) THEN CAST({value(c)} AS DOUBLE) END, 0.0) AS {x}"
                     for c, x in zip(features, xs))
    lane = lambda text, i: f"(('0x' || substr(md5({text}), {8 * i + 1}, 8))::BIGINT % {PRIME})"
    units = lambda n: (f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} <= 2 THEN {UNIT} ELSE "  # noqa: E731
                       f"round((2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n}) * {UNIT})::BIGINT END")
    label = group if group else f"'{C.GLOBAL_MODEL_KEY}'"
    small = f"seg_n < {min_size}" if group else "FALSE"
    out = [f"""
if_base AS (SELECT BusinessPartner AS partner, {label} AS seg, count(*) OVER (PARTITION BY {label}) AS seg_n, {flat} FROM {source}),
if_route AS (SELECT partner, CASE WHEN {small} THEN '{C.GLOBAL_MODEL_KEY}' ELSE seg END AS model FROM if_base),
if_member AS (
  SELECT seg AS model, partner, {', '.join(xs)} FROM if_base WHERE NOT ({small})
  UNION ALL SELECT '{C.GLOBAL_MODEL_KEY}', partner, {', '.join(xs)} FROM if_base WHERE (SELECT bool_or({small}) FROM if_base)
),
if_lane AS (
  SELECT *, count(*) OVER (PARTITION BY model) AS n, {lane(f"model || '|' || partner || '|{seed}'", 0)} AS a,
         {lane(f"model || '|' || partner || '|{seed}'", 1)} AS b, {lane(f"model || '|' || partner || '|{seed}'", 2)} AS tie
  FROM if_member
),
if_tree AS (
  SELECT model, tree, {lane(f"model || '|' || tree || '|{seed}'", 0)} AS ta, {lane(f"model || '|' || tree || '|{seed}'", 1)} AS tb
  FROM (SELECT DISTINCT model FROM if_member), range({trees}) t(tree)
),
if_r0 AS (
  SELECT m.model, t.tree, m.partner, ta, tb, 1::BIGINT AS node, NULL::BIGINT AS leaf, least(n, {max_samples}) AS psi,
         row_number() OVER (PARTITION BY m.model, t.tree ORDER BY (a * (t.tree + 1) + b) % {PRIME}, tie, m.partner) <= {max_samples} AS drawn,
         {', '.join(xs)}
  FROM if_lane m JOIN if_tree t ON t.model = m.model
)"""]
    hashed = lambda i: f"(sq * {lanes(f'feature|{i}|{seed}', 1)[0]} + h) % {PRIME} * 1024 + {1023 - i}"
    deepest = max_depth(max_samples)
    for d in range(deepest + 1):
        best = "greatest(" + ", ".join(f"CASE WHEN hi{i} > lo{i} AND cnt > 1 THEN {hashed(i)} ELSE -1 END" for i in range(k)) + ", -1)"
        pick = lambda c: "CASE f " + " ".join(f"WHEN {i} THEN {c}{i}" for i in range(k)) + " END"
        out.append(f"""
if_h{d} AS (
  SELECT *, h * h % {PRIME} AS sq FROM (
    SELECT model, tree, node, (any_value(ta) * node + any_value(tb)) % {PRIME} AS h, any_value(psi) AS psi, count(*) AS cnt,
           {', '.join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in range(k))}
    FROM if_r{d} WHERE drawn AND leaf IS NULL GROUP BY model, tree, node)
),
if_n{d} AS (
  SELECT model, tree, node, cnt, f, CASE WHEN cut >= hi THEN lo ELSE cut END AS t FROM (
    SELECT *, lo + ((sq * {lanes(f'cut|{seed}', 1)[0]} + h) % {PRIME}) / {float(PRIME)!r} * (hi - lo) AS cut FROM (
      SELECT *, {pick('lo')} AS lo, {pick('hi')} AS hi FROM (
        SELECT *, CASE WHEN best < 0 OR {d} >= ceil(log2(greatest(psi, 2))) THEN -1 ELSE 1023 - best % 1024 END AS f
        FROM (SELECT *, {best} AS best FROM if_h{d})))) 
),
if_r{d + 1} AS (
  SELECT r.model, r.tree, r.partner, ta, tb, drawn, psi, {', '.join(xs)},
         CASE WHEN r.leaf IS NULL AND f < 0 THEN {d} * {UNIT} + {units('cnt')} ELSE r.leaf END AS leaf,
         CASE WHEN r.leaf IS NULL AND f >= 0 THEN 2 * r.node + ({pick('x')} > t)::BIGINT ELSE r.node END AS node
  FROM if_r{d} r LEFT JOIN if_n{d} s ON r.leaf IS NULL AND s.model = r.model AND s.tree = r.tree AND s.node = r.node
)""")
    out.append(f"""
if_scores AS (
  SELECT model, partner, CASE WHEN expected > 0 THEN -pow(2.0, -(total::DOUBLE / expected::DOUBLE)) ELSE -0.5 END AS score
  FROM (SELECT model, partner, sum(leaf)::BIGINT AS total, sum({units('psi')})::BIGINT AS expected FROM if_r{deepest + 1} GROUP BY model, partner)
)""")
    return ",".join(out)


def forest_offsets(contaminations: tuple[float, ...]) -> str:
    """CTE ``if_offset`` (model, contamination, offset): the quantiles of each model's scores."""
    at = " UNION ALL ".join(f"SELECT {c!r}::DOUBLE AS contamination" for c in contaminations)
    return f"""
if_ranked AS (SELECT model, score, row_number() OVER (PARTITION BY model ORDER BY score) - 1 AS rk,
                     count(*) OVER (PARTITION BY model) AS n FROM if_scores),
if_offset AS (
  SELECT model, contamination, max(score) FILTER (rk = low) + (max(score) FILTER (rk = least(low + 1, n - 1)) - max(score) FILTER (rk = low))
         * (max(pos) - max(low)) AS offset_
  FROM (SELECT *, contamination * (n - 1) AS pos, floor(contamination * (n - 1)) AS low FROM if_ranked, ({at}))
  GROUP BY model, contamination
)"""
