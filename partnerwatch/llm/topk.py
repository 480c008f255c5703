"""Exact top-k search by norm-sorted inner products.

Candidates are sorted by descending length, globally, into blocks of some
thousand vectors. All vectors are rotated by the right singular vectors of the
candidates (from their second moments, summed over all rows), so the first
coordinates carry most of an inner product. A query starts with a threshold,
its k-th score among the longest vectors, and then

- goes only to blocks with |q| * (longest |v| of the block) >= threshold,
- stops inside a block at the first chunk of vectors that are too short,
- sums the first coordinates only, and drops each candidate whose partial sum
  plus the Cauchy-Schwarz bound of the rest, |q_rest| * |v_rest|, is below it.

What survives is scored exactly in integers. Bounds are widened by more than
the rounding error of the rotation and compared with ``<``, so ties survive.

Queries meet candidates in groups (block of candidates, block of queries) of
bounded size. The driver sees one number for each block, d x d second moments
and the ``HEAD`` longest vectors.

Defined results: vectors that are null, or hold null or non-finite components,
take no part; shorter vectors count as filled up with zeros; of rows that
repeat a vec_id the smallest vector counts; rows without vec_id take no part; a
query with fewer than k candidates gets all. Scaled components and scores beyond
a long are held at its limits. An empty table gives an empty result. Further
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch.llm.common import shared_table

BLOCK, QUERY_BLOCK, HEAD, CHUNK = 4096, 2048, 1024, 512
RESULT = "query_id long, vec_id long, score long"


def scaled_vectors(df: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of each component, as doubles."""
    x = F.col(embedding).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.where(F.col(vec_id).isNotNull() & x.isNotNull() & fine)
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("double"))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def second_moments(vectors: DataFrame, dims: int) -> np.ndarray:
    """Sum of v v^T over all rows: d * d numbers for each task, added up by Spark."""

    def moments(frames):
        total = np.zeros((dims, dims))
        for f in frames:
            m = _matrix(f["v"], dims)
            total += m.T @ m
        yield pd.DataFrame({"i": np.arange(dims), "row": list(total)})

    rows = vectors.select("v").mapInPandas(moments, "i int, row array<double>")
    sums = rows.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow().to_pandas()
    out = np.zeros((dims, dims))
    out[sums["i"], sums["j"]] = sums["x"]
    return out


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``q`` and ``v``, pair by pair, in integers."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2**53:
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, v)]
    return np.array([min(max(s, 1 - 2**63), 2**63 - 1) for s in exact], np.int64)


class _Best:
    """The k best (score, then smaller vec_id) of each query so far."""

    def __init__(self, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.copy()
        self.q = self.v = self.s = np.empty(0, np.int64)

    def add(self, q: np.ndarray, v: np.ndarray, s: np.ndarray) -> None:
        q, v, s = (np.concatenate(x) for x in ((self.q, q), (self.v, v), (self.s, s)))
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.q, self.v, self.s = q[kept], v[kept], s[kept]
        last = rank == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], s[last])


def search_block(queries: pd.DataFrame, items: pd.DataFrame, rotation: np.ndarray, head: int, k: int) -> pd.DataFrame:
    """Best candidates of one block for each query of one block."""
    dims = len(rotation)
    items = items.sort_values(["norm", "vec_id"], ascending=[False, True])
    q, v = _matrix(queries["v"], dims), _matrix(items["v"], dims)
    q_ids, v_ids, norms = queries["vec_id"].to_numpy(), items["vec_id"].to_numpy(), items["norm"].to_numpy()
    q_norms = np.sqrt((q * q).sum(1))
    qr, vr = q @ rotation, v @ rotation
    q_rest, v_rest = (np.sqrt((x[:, head:] ** 2).sum(1)) for x in (qr, vr))
    best = _Best(k, queries["floor"].to_numpy(float))
    for at in range(0, len(v), CHUNK):
        chunk = slice(at, at + CHUNK)
        slack = 1e-9 * q_norms * norms[at] + 1e-6
        live = np.flatnonzero(q_norms * norms[at] + slack >= best.floor)
        if not len(live):
            break
        bound = qr[live, :head] @ vr[chunk, :head].T + np.outer(q_rest[live], v_rest[chunk])
        qi, vi = np.nonzero(bound + slack[live, None] >= best.floor[live, None])
        qi, vi = live[qi], vi + at
        other = q_ids[qi] != v_ids[vi]
        qi, vi = qi[other], vi[other]
        for part in range(0, len(qi), 1 << 16):
            a, b = qi[part : part + (1 << 16)], vi[part : part + (1 << 16)]
            score = _exact(q[a], v[b])
            high = score >= best.floor[a]
            best.add(a[high], v_ids[b[high]], score[high])
    return pd.DataFrame({"query_id": q_ids[best.q], "vec_id": best.v, "score": best.s})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, head_share: float = 0.8) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query;
    ``vectors`` has vec_id and the components ``v``, see ``scaled_vectors``."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.withColumn("norm", norm)
    n_blocks = max(1, -(-vectors.count() // BLOCK))
    ranged = rows.repartitionByRange(n_blocks, F.desc("norm"), F.xxhash64("vec_id"))
    items = shared_table(ranged.withColumn("block", F.spark_partition_id()), "topk-items")
    found = items.agg(F.max(F.size("v"))).first()[0]
    dims = found or 1
    moments = second_moments(items, dims)
    values, rotation = np.linalg.eigh(moments)
    values, rotation = values[::-1].clip(0), np.ascontiguousarray(rotation[:, ::-1])
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    head = int(min(dims, np.searchsorted(share, head_share) + 1))
    longest = items.orderBy(F.desc("norm"), "vec_id").limit(HEAD).toArrow().to_pandas()
    tops = items.groupBy("block").agg(F.max("norm").alias("top")).orderBy(F.desc("top")).collect()
    blocks, most = [r["block"] for r in tops], np.array([r["top"] for r in tops])

    def start(frames):
        first = longest.sort_values(["norm", "vec_id"], ascending=[False, True])
        v, ids = _matrix(first["v"], dims), first["vec_id"].to_numpy()
        for f in frames:
            q = _matrix(f["v"], dims)
            scores = np.where(f["vec_id"].to_numpy()[:, None] == ids, -np.inf, q @ v.T)
            floor = np.partition(scores, len(ids) - k, axis=1)[:, -k] if len(ids) >= k else np.full(len(q), -np.inf)
            norms = np.sqrt((q * q).sum(1))
            floor = floor - 1e-9 * np.abs(floor) - 1e-6 if len(ids) else floor
            last = np.searchsorted(-most, -(floor / np.maximum(norms, 1e-300)), side="right")
            last = np.where((norms == 0) | (floor <= 0), len(most), np.minimum(last + 1, len(most)))
            yield pd.DataFrame({"vec_id": f["vec_id"], "v": f["v"], "floor": floor, "blocks": [blocks[:n] for n in last]})

    queries = items.where(is_query).select("vec_id", "v")
    n_query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    placed = queries.mapInPandas(start, "vec_id long, v array<double>, floor double, blocks array<int>")
    placed = shared_table(placed.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(n_query_blocks)).cast("int")), "topk-queries")
    sent = placed.select("vec_id", "v", "floor", "query_block", F.explode("blocks").alias("block"))
    wanted = sent.select(F.col("block").alias("to_block"), F.col("query_block").alias("from_block")).distinct()
    met = items.join(wanted, F.col("block") == F.col("to_block"))
    pairs = sent.groupBy("block", "query_block").cogroup(met.groupBy("to_block", "from_block"))
    found = pairs.applyInPandas(lambda q, i: search_block(q, i, rotation, head, k), RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
