"""Group statistics that stay distributed however large a group is.

* ``group_moments``: mean / sample std / population std / count per group and
  feature. Decomposable aggregates, so a hot group is pre-combined map side.
* ``group_quantiles``: exact linear-interpolation quantiles (numpy / pandas
  ``linear``, DuckDB ``quantile_cont``, Spark ``percentile``) per group and
  feature. Spark's ``percentile`` keeps every distinct value of a group in one
  task's buffer, which does not spill; here a group is instead spread over a
  range-partitioned shuffle of its distinct values:

  1. distinct (group, feature, value) with counts: partial aggregation folds
     repeated values (a value held by a third of all rows costs one row);
  2. ``repartitionByRange`` on (group, feature, value) and one small aggregate
     per (partition, group, feature) segment: value range + row count;
  3. prefix sums over the segment table (a few rows per partition) give each
     segment's rank interval; only segments holding a wanted rank are kept;
  4. the distinct values of those segments (bounded by one range partition)
     are ranked by a window and the two neighbours of each position picked.

  No step holds more than one range partition of a group in a task, nothing
  is collected, and the plan is deterministic (segments are identified by
  their value range, not by task numbering).
* ``attach``: join a per-group statistics table back to the rows; broadcast
  only when the caller states a bound on the number of groups. One-row
  (global) statistics become a scalar subquery instead of a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch.functions.scalar import nan_to_null

# Broadcast a statistics table only when its proven row bound is below this.
# The largest bounded tables here are the forest's cut-off table (models x
# trees = 67 x 200) and per-group quantiles (66 rows x ~60 doubles): a few MB.
BROADCAST_GROUP_LIMIT = 20_000

_F = "_feature"
_V = "_value"
_C = "_count"


def to_long(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
            as_index: bool = False) -> DataFrame:
    """(group..., feature, value) rows, NaN/NULL values dropped (pandas skips them).
    With ``as_index`` the feature is its position (an int) instead of its name,
    which keeps the shuffled rows narrow."""
    pairs = F.array(*[F.struct((F.lit(i) if as_index else F.lit(c)).alias(_F), nan_to_null(c).alias(_V))
                      for i, c in enumerate(value_cols)])
    return (
        df.select(*group_cols, F.inline(pairs))
        .filter(F.col(_V).isNotNull())
    )


def attach(df: DataFrame, stats: DataFrame, group_cols: Sequence[str],
           group_bound: int | None = None) -> DataFrame:
    """Join per-group statistics back to rows.

    ``group_bound`` is a proven upper bound on the number of groups (for example
    the size of the code tables the group key is built from). Without it the
    join is left to the planner, and AQE turns it into a broadcast at run time
    only when the statistics actually turn out small.
    """
    if not group_cols:
        # one-row statistics: a scalar subquery, computed once and inlined as a
        # value (no join, stays inside whole-stage codegen)
        sub = stats.select(F.struct(*stats.columns)).scalar()
        return (df.withColumn("_attach", sub)
                .select("*", *[F.col(f"_attach.{c}").alias(c) for c in stats.columns])
                .drop("_attach"))
    small = group_bound is not None and group_bound <= BROADCAST_GROUP_LIMIT
    return df.join(F.broadcast(stats) if small else stats, list(group_cols), "left")


def group_moments(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                  prefix: str = "") -> DataFrame:
    """One row per group: ``{prefix}{c}__mean``, ``__std`` (sample), ``__pstd``
    (population), ``__n`` (non-null count) for every value column."""
    aggs = []
    for c in value_cols:
        v = nan_to_null(c)
        aggs += [
            F.avg(v).alias(f"{prefix}{c}__mean"),
            F.stddev_samp(v).alias(f"{prefix}{c}__std"),
            F.stddev_pop(v).alias(f"{prefix}{c}__pstd"),
            F.count(v).alias(f"{prefix}{c}__n"),
        ]
    return df.groupBy(*group_cols).agg(*aggs)


def _quantile_long(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                   partitions: int | None, targets_bound: int | None = None) -> DataFrame:
    """Core of ``group_quantiles`` on (keys..., _value) rows -> keys..., q0, q1, ...
    ``targets_bound`` is a proven bound on the segments that hold wanted ranks."""
    keys = list(keys)
    counts = long.groupBy(*keys, _V).agg(F.count(F.lit(1)).alias(_C))

    ranged = (counts.repartitionByRange(partitions, *keys, _V) if partitions
              else counts.repartitionByRange(*keys, _V))
    segments = (
        ranged.withColumn("_part", F.spark_partition_id())
        .groupBy("_part", *keys)
        .agg(F.min(_V).alias("_lo"), F.max(_V).alias("_hi"), F.sum(_C).alias("_tot"))
        .drop("_part")
    )
    w_all = Window.partitionBy(*keys)
    w_before = w_all.orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select(
        *keys, "_lo", "_hi", "_tot",
        F.coalesce(F.sum("_tot").over(w_before), F.lit(0)).alias("_start"),
        F.sum("_tot").over(w_all).alias("_n"),
    )
    # wanted ranks (0-based): floor(p * (n - 1)) and its upper neighbour
    pos = {i: F.lit(float(p)) * (F.col("_n") - 1).cast("double") for i, p in enumerate(probs)}
    lo_rank = {i: F.floor(pos[i]).cast("bigint") for i in pos}
    hi_rank = {i: F.least(lo_rank[i] + 1, F.col("_n") - 1) for i in pos}
    end = F.col("_start") + F.col("_tot")

    def covers(r):
        return (F.col("_start") <= r) & (r < end)

    wanted = F.lit(False)
    for i in pos:
        wanted = wanted | covers(lo_rank[i]) | covers(hi_rank[i])
    targets = segments.filter(wanted)
    if targets_bound is not None and targets_bound <= BROADCAST_GROUP_LIMIT:
        targets = F.broadcast(targets)  # the counts then stay where they are, whatever a group's size

    # distinct values of the wanted segments only; ranked inside their segment
    cand = counts.join(targets, keys).filter((F.col(_V) >= F.col("_lo")) & (F.col(_V) <= F.col("_hi")))
    w_seg = Window.partitionBy(*keys, "_lo").orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    cand = cand.withColumn("_rend", F.col("_start") + F.sum(_C).over(w_seg))
    cand = cand.withColumn("_rbeg", F.col("_rend") - F.col(_C))

    def at(r):
        return F.max(F.when((F.col("_rbeg") <= r) & (r < F.col("_rend")), F.col(_V)))

    picked = cand.groupBy(*keys).agg(
        F.first("_n").alias("_n"),
        *[at(lo_rank[i]).alias(f"_vlo{i}") for i in pos],
        *[at(hi_rank[i]).alias(f"_vhi{i}") for i in pos],
    )
    out = [F.col(k) for k in keys] + [F.col("_n").alias("n")]
    for i, p in enumerate(probs):
        frac = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        frac = frac - F.floor(frac)
        lo, hi = F.col(f"_vlo{i}"), F.col(f"_vhi{i}")
        out.append((lo + (hi - lo) * frac).alias(f"q{i}"))
    return picked.select(*out)


def group_quantiles(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                    probs: Sequence[float], partitions: int | None = None,
                    group_bound: int | None = None) -> DataFrame:
    """Long result: (group..., ``_feature``, ``n``, ``q0``, ``q1``, ...); the
    shuffles carry a feature index, the name is put back on the small result.
    A group and feature has at most two segments with wanted ranks for each
    probability, so ``group_bound`` (see ``attach``) bounds their number."""
    long = to_long(df, group_cols, value_cols, as_index=True)
    groups = group_bound if group_cols else 1
    bound = None if groups is None else groups * len(value_cols) * 2 * len(probs)
    out = _quantile_long(long, [*group_cols, _F], probs, partitions, bound)
    names = F.array(*[F.lit(c) for c in value_cols])
    return out.withColumn(_F, F.element_at(names, F.col(_F) + 1))


def group_quantiles_wide(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                         probs: Sequence[float], names: Sequence[str],
                         partitions: int | None = None, group_bound: int | None = None) -> DataFrame:
    """One row per group with ``{col}__{name}`` for every value column and prob.

    Groups that have no non-null value for a column get NULL for it.
    """
    long = group_quantiles(df, group_cols, value_cols, probs, partitions, group_bound)
    aggs = []
    for c in value_cols:
        is_c = F.col(_F) == F.lit(c)
        aggs += [F.max(F.when(is_c, F.col(f"q{i}"))).alias(f"{c}__{nm}") for i, nm in enumerate(names)]
        aggs.append(F.max(F.when(is_c, F.col("n"))).alias(f"{c}__qn"))
    keys = list(group_cols)
    if keys:
        return long.groupBy(*keys).agg(*aggs)
    return long.agg(*aggs)


def column_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                     names: Sequence[str], group_cols: Sequence[str] = (),
                     group_bound: int | None = None) -> DataFrame:
    """Quantiles of one column (optionally per group), columns named by ``names``."""
    wide = group_quantiles_wide(df, group_cols, [value_col], probs, names, group_bound=group_bound)
    return wide.select(*group_cols, *[F.col(f"{value_col}__{nm}").alias(nm) for nm in names])


# ------------------------------------------------------------------ mergeable sketches
def quantile_sketches(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], k: int = 200) -> DataFrame:
    """KLL sketches by group and feature: (group..., ``_feature``, ``_sketch``). Their size
    depends on ``k`` alone, so a day's sketches can be stored and merged later. The rank
    error is about 1.33 / k ** 0.9 (99 % confidence); exact quantiles stay the default,
    nothing switches by size."""
    long = to_long(df, group_cols, value_cols)
    return long.groupBy(*group_cols, _F).agg(F.kll_sketch_agg_double(_V, F.lit(k)).alias("_sketch"))


def merge_sketches(sketches: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Sketches of several days (a union), or of finer groups, as those of ``group_cols``."""
    return sketches.groupBy(*group_cols, _F).agg(F.kll_merge_agg_double("_sketch").alias("_sketch"))


def sketched_quantiles(sketches: DataFrame, group_cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(group..., ``_feature``, ``n``, ``q0``, ...) from sketches."""
    values = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)]
    return sketches.select(*group_cols, _F, F.kll_sketch_get_n_double("_sketch").alias("n"), *values)


def rank_error(k: int) -> float:
    """The rank error that ``quantile_sketches`` states for ``k``."""
    return 2.296 / k ** 0.9021


def distinct_sketches(df: DataFrame, group_cols: Sequence[str], cols: Sequence[str], lg_k: int = 12) -> DataFrame:
    """Theta sketches of distinct values by group: (group..., ``{col}__theta``); exact up to
    2 ** lg_k values of a group, relative error about 1 / sqrt(2 ** lg_k) beyond."""
    return df.groupBy(*group_cols).agg(*[F.theta_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"{c}__theta") for c in cols])


def union_distinct(sketches: DataFrame, group_cols: Sequence[str], cols: Sequence[str], lg_k: int = 12) -> DataFrame:
    """Distinct counts of merged sketches: (group..., ``{col}__distinct``)."""
    return sketches.groupBy(*group_cols).agg(*[F.theta_sketch_estimate(F.theta_union_agg(f"{c}__theta", F.lit(lg_k))).alias(f"{c}__distinct")
                                               for c in cols])
