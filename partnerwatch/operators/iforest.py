"""Isolation Forest per peer group, trained and scored as Spark jobs (M2-M6).

Semantics (Liu, Ting & Zhou 2008; scikit-learn's public documentation):
psi = min(max_samples, n) rows per tree, drawn without replacement; height
limit ceil(log2 psi); at each node a random feature among those not constant
in the node and a uniform cut in [min, max); path length = depth + c(leaf
size); score = -2^(-mean path / c(psi)); offset = the ``contamination``
quantile of the training scores; flag when score - offset < 0. Path lengths are
added up in units of 2^-32, so their sums do not depend on the order. Groups under
``min_segment_size`` partners are scored by a model trained on all partners.

Plan shape:

* membership: each partner -> its own group's model and, only when some
  group is small, the global model (an ``explode`` of at most two keys);
* randomness is counter-based: every draw is a hash of the seed and of what it
  is for (model and partner and tree; model and tree and node; feature), made of
  md5 lanes and arithmetic modulo a prime, so a tree is the same under any
  partitioning and retry, and any engine with integers grows the same forest;
* sampling: a row has two md5 lanes (a, b) for each model and joins tree t when
  u = (a (t + 1) + b) mod prime is below p = min(1, (psi + 6 sqrt(psi) + 16) / n);
  the psi smallest u of a tree are its sample. One pass makes n * trees products
  and one shuffle brings about psi + 6 sqrt(psi) rows a tree to its fit;
* fitting: ``groupBy(model, block of trees).applyInPandas``; numpy cuts each
  tree's rows to its psi smallest u and grows it level by level;
* scoring: ``cogroup`` on (model, salt); rows are spread over
  ceil(n / rows_per_task) salts and each model's forest is replicated to its
  salts, so no task holds more than ``rows_per_task`` partners or one forest;
* offsets: exact distributed quantiles (``functions.stats``), one row per
  model, broadcast (models are bounded by the peer-group code tables + 1).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerwatch.config import GLOBAL_MODEL_KEY
from partnerwatch.functions import stats

PRIME = 2_147_483_647
UNIT = 1 << 32
_MK = "_model_key"
_PK = "_partner"

FOREST_SCHEMA = T.StructType([
    T.StructField(_MK, T.StringType()),
    T.StructField("_tree", T.IntegerType()),
    T.StructField("_psi", T.IntegerType()),
    T.StructField("_feat", T.ArrayType(T.IntegerType())),
    T.StructField("_thr", T.ArrayType(T.DoubleType())),
    T.StructField("_left", T.ArrayType(T.IntegerType())),
    T.StructField("_right", T.ArrayType(T.IntegerType())),
    T.StructField("_leaf", T.ArrayType(T.LongType())),
])

SCORE_SCHEMA = T.StructType([
    T.StructField(_MK, T.StringType()),
    T.StructField(_PK, T.StringType()),
    T.StructField("_score", T.DoubleType()),
])


def average_path_length(n: float) -> float:
    """c(n): expected path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _bounded(df: DataFrame, rows_bound: int | None) -> DataFrame:
    """Broadcast a per-model table only when its row count has a proven bound."""
    return F.broadcast(df) if rows_bound is not None and rows_bound <= stats.BROADCAST_GROUP_LIMIT else df


def path_units(n: int) -> int:
    """c(n) in units of 2^-32."""
    return round(average_path_length(n) * UNIT)


def lanes(text: str, n: int) -> list[int]:
    """``n`` (at most 4) numbers below PRIME from a text."""
    import hashlib

    digits = hashlib.md5(text.encode()).hexdigest()
    return [int(digits[8 * i:8 * i + 8], 16) % PRIME for i in range(n)]


def _lane(text: F.Column, i: int) -> F.Column:
    """Column twin of ``lanes``."""
    return F.conv(F.substring(F.md5(text), 8 * i + 1, 8), 16, 10).cast("bigint") % F.lit(PRIME)


def feature_columns(cols: Sequence[str]) -> list[F.Column]:
    """Model input ``_x0.._x{d-1}``: NULL and NaN -> 0, one double column per
    feature (Arrow hands plain double columns to numpy without copies)."""
    return [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(f"_x{i}")
            for i, c in enumerate(cols)]


def _xcols(n: int) -> list[str]:
    return [f"_x{i}" for i in range(n)]


def assign_models(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None,
                  min_segment_size: int, partner_col: str,
                  group_bound: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return (members, model_sizes, routing).

    members: (_model_key, _partner, _x0.._x{d-1}), one row per (model, partner) a
    model trains on and scores; model_sizes: (_model_key, _n); routing:
    (_partner, _own_key) the model whose score a partner keeps.
    """
    xs = _xcols(len(feature_cols))
    base = df.select(F.col(partner_col).cast("string").alias(_PK),
                     (F.col(segment_col).cast("string") if segment_col else F.lit(GLOBAL_MODEL_KEY)).alias("_seg"),
                     *feature_columns(feature_cols))
    if not segment_col:
        sizes = base.groupBy().agg(F.count(F.lit(1)).alias("_n")).select(F.lit(GLOBAL_MODEL_KEY).alias(_MK), "_n")
        members = base.select(F.lit(GLOBAL_MODEL_KEY).alias(_MK), _PK, *xs)
        routing = base.select(_PK, F.lit(GLOBAL_MODEL_KEY).alias("_own_key"))
        return members, sizes, routing

    seg_sizes = base.groupBy("_seg").agg(F.count(F.lit(1)).alias("_segn"))
    overall = seg_sizes.agg(F.max((F.col("_segn") < min_segment_size).cast("int")).alias("_any_small"),
                            F.sum("_segn").alias("_total"))
    seg_sizes = stats.attach(seg_sizes, overall, [])
    tagged = base.join(_bounded(seg_sizes, group_bound), "_seg")
    own = F.when(F.col("_segn") >= min_segment_size, F.col("_seg")).otherwise(F.lit(GLOBAL_MODEL_KEY))
    keys = F.array_compact(F.array(
        F.when(F.col("_segn") >= min_segment_size, F.col("_seg")),
        F.when(F.col("_any_small") == 1, F.lit(GLOBAL_MODEL_KEY)),
    ))
    members = tagged.select(F.explode(keys).alias(_MK), _PK, *xs)
    routing = tagged.select(_PK, own.alias("_own_key"))
    own_models = seg_sizes.filter(F.col("_segn") >= min_segment_size).select(F.col("_seg").alias(_MK), F.col("_segn").alias("_n"))
    global_model = (seg_sizes.filter(F.col("_any_small") == 1)
                    .groupBy().agg(F.max("_total").alias("_n"))
                    .filter(F.col("_n").isNotNull())
                    .select(F.lit(GLOBAL_MODEL_KEY).alias(_MK), "_n"))
    return members, own_models.unionByName(global_model), routing


def sample_for_trees(members: DataFrame, model_sizes: DataFrame, n_estimators: int,
                     max_samples: int, seed: int, model_bound: int | None = None) -> DataFrame:
    """(_model_key, _tree, _u, _tie, _partner, _x0.., _psi): the rows that may be
    among the psi smallest (_u, _tie, _partner) of a tree.

    The pre-filter keeps Binomial(n, p) rows per tree with mean
    psi + 6 sqrt(psi) + 16, so fewer than psi survive with probability about
    Phi(-5.8) ~ 3e-9 per tree; the tree is then grown on the survivors, which
    are still a uniform random subset."""
    xs = [c for c in members.columns if c.startswith("_x")]
    sized = members.join(_bounded(model_sizes, model_bound), _MK)
    psi = F.least(F.lit(max_samples), F.col("_n")).cast("int")
    p = F.least(F.lit(1.0), (psi + F.lit(6.0) * F.sqrt(psi.cast("double")) + F.lit(16.0)) / F.col("_n"))
    row = F.concat_ws("|", F.col(_MK), F.col(_PK), F.lit(str(seed)))
    sized = sized.select(_MK, _PK, *xs, psi.alias("_psi"), (p * F.lit(float(PRIME))).alias("_below"),
                         *[_lane(row, i).alias(c) for i, c in enumerate(("_a", "_b", "_tie"))])
    drawn = sized.withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(n_estimators - 1))))
    u = (F.col("_a") * (F.col("_tree").cast("bigint") + 1) + F.col("_b")) % F.lit(PRIME)
    drawn = drawn.withColumn("_u", u).filter(F.col("_u").cast("double") < F.col("_below"))
    return drawn.select(_MK, "_tree", "_u", "_tie", _PK, *xs, "_psi")


def _make_tree_builder(seed: int):
    """Pandas function fitting every tree of one (model, block) group.

    A tree is grown level by level: at each depth the rows of all open nodes
    are sorted by node, per-node min/max come from ``reduceat``, and the feature
    and the cut of every node come from hashes of its place in the tree (1 for the
    root, 2 i and 2 i + 1 for the parts of i), so a tree costs about
    ceil(log2 psi) vectorised steps.
    """

    def units(n):
        import numpy as np

        return np.array([path_units(x) for x in np.asarray(n).tolist()], dtype=np.int64)

    def grow(X, tree_lanes, feature_lanes, cut_lane, max_depth):
        import numpy as np

        n = X.shape[0]
        cap = 2 * n + 1
        feat = np.full(cap, -1, dtype=np.int64)
        thr = np.zeros(cap)
        left = np.full(cap, -1, dtype=np.int64)
        right = np.full(cap, -1, dtype=np.int64)
        leaf = np.zeros(cap, dtype=np.int64)
        place = np.ones(cap, dtype=np.int64)
        node_of = np.zeros(n, dtype=np.int64)
        rows = np.arange(n)          # rows still in open nodes
        lo_id, hi_id = 0, 1          # open nodes of this level are [lo_id, hi_id)
        n_nodes = 1
        depth = 0
        while rows.size:
            local = node_of[rows] - lo_id
            width = hi_id - lo_id
            counts = np.bincount(local, minlength=width)
            order = np.argsort(local, kind="stable")
            rows_sorted = rows[order]
            present = np.flatnonzero(counts)
            starts = np.concatenate(([0], np.cumsum(counts[present])[:-1]))
            Xs = X[rows_sorted]
            mins = np.minimum.reduceat(Xs, starts, axis=0)
            maxs = np.maximum.reduceat(Xs, starts, axis=0)
            ids = present + lo_id
            cnt = counts[present]
            if depth >= max_depth:
                leaf[ids] = depth * UNIT + units(cnt)
                break
            usable = (maxs > mins) & (cnt[:, None] > 1)
            can = usable.any(axis=1)
            leaf[ids[~can]] = depth * UNIT + units(cnt[~can])
            ids, mins, maxs, usable = ids[can], mins[can], maxs[can], usable[can]
            if ids.size == 0:
                break
            node = (tree_lanes[0] * (place[ids] % PRIME) + tree_lanes[1]) % PRIME
            squared = node * node % PRIME
            r = (squared[:, None] * feature_lanes[None, :] + node[:, None]) % PRIME
            r[~usable] = -1
            f = r.argmax(axis=1)
            k = np.arange(ids.size)
            lo, hi = mins[k, f], maxs[k, f]
            t = lo + (squared * cut_lane + node) % PRIME / float(PRIME) * (hi - lo)
            t = np.where(t >= hi, lo, t)
            feat[ids], thr[ids] = f, t
            left[ids] = n_nodes + 2 * k
            right[ids] = n_nodes + 2 * k + 1
            place[left[ids]], place[right[ids]] = 2 * place[ids], 2 * place[ids] + 1
            pos = np.full(width, -1, dtype=np.int64)
            pos[ids - lo_id] = k
            a = pos[node_of[rows] - lo_id]
            moving = a >= 0
            rows, a = rows[moving], a[moving]
            go_left = X[rows, f[a]] <= t[a]
            node_of[rows] = np.where(go_left, left[ids][a], right[ids][a])
            lo_id, hi_id = n_nodes, n_nodes + 2 * ids.size
            n_nodes = hi_id
            depth += 1
        return (feat[:n_nodes].tolist(), thr[:n_nodes].tolist(), left[:n_nodes].tolist(),
                right[:n_nodes].tolist(), leaf[:n_nodes].tolist())

    def build(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["_tree", "_u", "_tie", _PK], kind="mergesort")
        model_key = str(pdf[_MK].iloc[0])
        xs = sorted((c for c in pdf.columns if c.startswith("_x")), key=lambda c: int(c[2:]))
        features = np.array([lanes(f"feature|{i}|{seed}", 1)[0] for i in range(len(xs))], dtype=np.int64)
        cut = lanes(f"cut|{seed}", 1)[0]
        X_all = pdf[xs].to_numpy(dtype=np.float64)
        tree_ids = pdf["_tree"].to_numpy()
        bounds = np.flatnonzero(np.diff(tree_ids)) + 1
        wanted = int(pdf["_psi"].iloc[0])
        out = {_MK: [], "_tree": [], "_psi": [], "_feat": [], "_thr": [], "_left": [], "_right": [], "_leaf": []}
        for lo, hi in zip(np.r_[0, bounds], np.r_[bounds, len(tree_ids)]):
            tree, hi = int(tree_ids[lo]), min(hi, lo + wanted)
            psi = int(hi - lo)  # the rows that this tree has, which its scores are normalised by
            fe, th, le, ri, lf = grow(X_all[lo:hi], lanes(f"{model_key}|{tree}|{seed}", 2), features, cut,
                                      max_depth(psi))
            for key, val in ((_MK, model_key), ("_tree", tree), ("_psi", psi), ("_feat", fe), ("_thr", th),
                             ("_left", le), ("_right", ri), ("_leaf", lf)):
                out[key].append(val)
        return pd.DataFrame(out)

    return build


def max_depth(psi: int) -> int:
    """ceil(log2 psi), 1 at least."""
    return (max(psi, 2) - 1).bit_length()


def fit_forest(sample: DataFrame, seed: int, trees_per_task: int = 10) -> DataFrame:
    """One row per (model, tree) with the tree as parallel node arrays; trees are
    fitted ``trees_per_task`` at a time (about trees_per_task * (psi + 6 sqrt(psi))
    rows)."""
    block = (F.col("_tree") / F.lit(trees_per_task)).cast("int")
    return (sample.withColumn("_block", block)
            .groupBy(_MK, "_block")
            .applyInPandas(_make_tree_builder(seed), FOREST_SCHEMA))


def _make_scorer():
    def score(rows, trees):
        import numpy as np
        import pandas as pd

        if rows.empty or trees.empty:
            return pd.DataFrame({_MK: pd.Series([], dtype=str), _PK: pd.Series([], dtype=str),
                                 "_score": pd.Series([], dtype=float)})
        xs = sorted((c for c in rows.columns if c.startswith("_x")), key=lambda c: int(c[2:]))
        X = rows[xs].to_numpy(dtype=np.float64)
        m = X.shape[0]
        idx = np.arange(m)
        total = np.zeros(m, dtype=np.int64)
        for feat, thr, lft, rgt, leaf in zip(trees["_feat"], trees["_thr"], trees["_left"],
                                             trees["_right"], trees["_leaf"]):
            feat = np.asarray(feat, dtype=np.int64)
            thr = np.asarray(thr, dtype=np.float64)
            lft = np.asarray(lft, dtype=np.int64)
            rgt = np.asarray(rgt, dtype=np.int64)
            leaf = np.asarray(leaf, dtype=np.int64)
            node = np.zeros(m, dtype=np.int64)
            inner = feat[node] >= 0
            while inner.any():
                f = np.where(inner, feat[node], 0)
                go_left = X[idx, f] <= thr[node]
                node = np.where(inner, np.where(go_left, lft[node], rgt[node]), node)
                inner = feat[node] >= 0
            total += leaf[node]
        expected = sum(path_units(n) for n in trees["_psi"])
        # trees of one row tell nothing apart: the neutral score
        s = -np.power(2.0, -(total / float(expected))) if expected > 0 else np.full(m, -0.5)
        return pd.DataFrame({_MK: rows[_MK].to_numpy(), _PK: rows[_PK].to_numpy(), "_score": s})

    return score


def score_members(members: DataFrame, forest: DataFrame, model_sizes: DataFrame,
                  rows_per_task: int = 50_000, model_bound: int | None = None) -> DataFrame:
    """(_model_key, _partner, _score) for every member row."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(float(rows_per_task))).cast("int"))
    sizes = model_sizes.select(_MK, salts.alias("_salts"))
    rows = (members.join(_bounded(sizes, model_bound), _MK)
            .withColumn("_salt", F.pmod(F.xxhash64(F.col(_PK)), F.col("_salts").cast("long")).cast("int"))
            .drop("_salts"))
    trees = (forest.join(_bounded(sizes, model_bound), _MK)
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
             .drop("_salts"))
    return (rows.groupBy(_MK, "_salt")
            .cogroup(trees.groupBy(_MK, "_salt"))
            .applyInPandas(_make_scorer(), SCORE_SCHEMA))


def forest_scores(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None,
                  n_estimators: int, random_state: int, min_segment_size: int, partner_col: str,
                  max_samples: int = 256, rows_per_task: int = 50_000, materialize: bool = True,
                  group_bound: int | None = None):
    """(scores per member, model sizes, routing).

    With ``materialize`` the member scores are written once to the shared
    checkpoint folder: the offsets and the final join both read them, and an
    executor lost later does not re-run the Python fitting and scoring.

    ``group_bound`` is a proven bound on the number of groups; the per-model
    tables (at most groups + 1 rows, or that times the tree count) are
    broadcast only with it, else AQE decides at run time."""
    if not segment_col:
        group_bound = 1
    model_bound = None if group_bound is None else group_bound + 1
    members, sizes, routing = assign_models(df, feature_cols, segment_col, min_segment_size, partner_col,
                                            group_bound)
    sample = sample_for_trees(members, sizes, n_estimators, max_samples, random_state, model_bound)
    forest = fit_forest(sample, random_state)
    scores = score_members(members, forest, sizes, rows_per_task, model_bound)
    if materialize:
        from partnerwatch.session import cut_lineage

        scores = cut_lineage(scores, "if-scores")
    return scores, sizes, routing


def model_offsets(scores: DataFrame, contamination: float, model_bound: int | None = None) -> DataFrame:
    """(_model_key, _offset): the contamination quantile of each model's training scores."""
    return stats.column_quantiles(scores, "_score", (contamination,), ("_offset",), group_cols=[_MK], group_bound=model_bound)


def risk_from_scores(df: DataFrame, score_col: str = "isolation_forest_score") -> DataFrame:
    """M5: risk = 1 - (s - min) / (max - min) over the whole table (denominator 1 when flat)."""
    mm = df.agg(F.min(score_col).alias("_smin"), F.max(score_col).alias("_smax"))
    joined = stats.attach(df, mm, [])
    denom = F.when(F.col("_smax") != F.col("_smin"), F.col("_smax") - F.col("_smin")).otherwise(F.lit(1.0))
    return joined.withColumn("risk_score", F.lit(1.0) - (F.col(score_col) - F.col("_smin")) / denom).drop("_smin", "_smax")


def run_isolation_forest_by_segment(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None = "Segment",
                                    contamination: float = 0.05, n_estimators: int = 200,
                                    random_state: int = 42, min_segment_size: int = 10,
                                    partner_col: str = "BusinessPartner", max_samples: int = 256,
                                    rows_per_task: int = 50_000, group_bound: int | None = None) -> DataFrame:
    """M2-M5: adds ``isolation_forest_flag``, ``isolation_forest_score`` (decision
    value, lower = more anomalous) and ``risk_score`` (1 = most anomalous).

    ``partner_col`` must be unique (it is after the partner rollup).
    """
    feats = [c for c in feature_cols if c in df.columns]
    scores, _sizes, routing = forest_scores(df, feats, segment_col, n_estimators, random_state,
                                            min_segment_size, partner_col, max_samples, rows_per_task,
                                            group_bound=group_bound)
    model_bound = 2 if not segment_col else (None if group_bound is None else group_bound + 1)
    offsets = model_offsets(scores, contamination, model_bound)
    kept = (scores.join(routing, _PK)
            .filter(F.col(_MK) == F.col("_own_key"))
            .join(_bounded(offsets, model_bound), _MK)
            .select(F.col(_PK), (F.col("_score") - F.col("_offset")).alias("isolation_forest_score")))
    kept = kept.withColumn("isolation_forest_flag", F.col("isolation_forest_score") < 0)
    out = df.join(kept.withColumnRenamed(_PK, "_pk_join"),
                  F.col(partner_col).cast("string") == F.col("_pk_join"), "left").drop("_pk_join")
    return risk_from_scores(out, "isolation_forest_score")


def model_routing(df: DataFrame, segment_col: str, min_segment_size: int = 10,
                  partner_col: str = "BusinessPartner") -> DataFrame:
    """M3: which model scores each partner (own group or ``__GLOBAL__``)."""
    _m, _s, routing = assign_models(df, [], segment_col, min_segment_size, partner_col)
    return routing.select(F.col(_PK).alias(partner_col), F.col("_own_key").alias("model_key"))


def flag_counts(df: DataFrame, feature_cols: Sequence[str], segment_col: str | None, contamination: float,
                n_estimators: int, random_state: int, min_segment_size: int,
                partner_col: str = "BusinessPartner", group_bound: int | None = None) -> DataFrame:
    """M4 check table: per model, training rows and rows below the offset."""
    feats = [c for c in feature_cols if c in df.columns]
    scores, _sizes, _routing = forest_scores(df, feats, segment_col, n_estimators, random_state,
                                             min_segment_size, partner_col, group_bound=group_bound)
    model_bound = None if group_bound is None else group_bound + 1
    offsets = model_offsets(scores, contamination, model_bound)
    return (scores.join(_bounded(offsets, model_bound), _MK)
            .groupBy(F.col(_MK).alias("model_key"))
            .agg(F.count(F.lit(1)).alias("n_train"),
                 F.count_if(F.col("_score") < F.col("_offset")).alias("flagged")))


def _below_thresholds(df: DataFrame, feature_cols: Sequence[str], contaminations: Sequence[float],
                      n_estimators: int, random_state: int, partner_col: str) -> tuple[DataFrame, list[str]]:
    """Scores of one global forest with the quantile of each contamination."""
    feats = [c for c in feature_cols if c in df.columns]
    scores, _sizes, _routing = forest_scores(df, feats, None, n_estimators, random_state, 1, partner_col)
    names = [f"c{i}" for i in range(len(contaminations))]
    return stats.attach(scores, stats.column_quantiles(scores, "_score", contaminations, names), []), names


def contamination_flags(df: DataFrame, feature_cols: Sequence[str],
                        contaminations: Sequence[float] = (0.01, 0.02, 0.05, 0.10, 0.15),
                        n_estimators: int = 100, random_state: int = 42,
                        partner_col: str = "BusinessPartner") -> DataFrame:
    """M6 by partner: (partner, contamination, flagged) of one global forest."""
    joined, names = _below_thresholds(df, feature_cols, contaminations, n_estimators, random_state, partner_col)
    rows = F.array(*[F.struct(F.lit(float(c)).alias("contamination"), (F.col("_score") < F.col(nm)).alias("flagged"))
                     for c, nm in zip(contaminations, names)])
    return joined.select(F.col(_PK).alias(partner_col), F.inline(rows))


def contamination_sweep(df: DataFrame, feature_cols: Sequence[str],
                        contaminations: Sequence[float] = (0.01, 0.02, 0.05, 0.10, 0.15),
                        n_estimators: int = 100, random_state: int = 42,
                        partner_col: str = "BusinessPartner") -> DataFrame:
    """M6: one global forest; flagged count and percentage per contamination."""
    joined, names = _below_thresholds(df, feature_cols, contaminations, n_estimators, random_state, partner_col)
    counts = joined.agg(F.count(F.lit(1)).alias("_n"),
                        *[F.count_if(F.col("_score") < F.col(nm)).alias(f"_f{i}") for i, nm in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(float(c)).alias("contamination"), F.col(f"_f{i}").alias("flagged"))
                     for i, c in enumerate(contaminations)])
    return counts.select("_n", F.inline(rows)).select(
        "contamination", "flagged", (F.col("flagged") / F.col("_n") * 100).alias("pct"))
