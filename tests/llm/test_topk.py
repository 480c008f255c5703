from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from partnerwatch.llm import topk as K
from tests.llm.data import rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, every, k, scale=256):
    kept = {}
    for i, e in data:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [int(float(min(max(math.floor(scale * float(np.float32(x))), -(2**63)), 2**63 - 1))) for x in e]
        kept[i] = min(kept.get(i, v), v)
    out = []
    for q in sorted(x for x in kept if x % every == 0):
        held = lambda s: min(max(s, 1 - 2**63), 2**63 - 1)
        scores = sorted((-held(sum(a * b for a, b in zip(kept[q], v))), i) for i, v in kept.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def run(spark, data, every=5, k=3):
    df = spark.createDataFrame([(i, e, 0) for i, e in data], SCHEMA)
    return rows(K.top_k(K.scaled_vectors(df, 256), F.col("vec_id") % every == 0, k), "query_id", "rank")


@pytest.mark.parametrize("kind", ["unit", "spread", "ties", "negative"])
def test_same_as_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(K, "HEAD", 40)
    monkeypatch.setattr(K, "BLOCK", 100)
    monkeypatch.setattr(K, "QUERY_BLOCK", 30)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) @ np.diag(np.geomspace(3, 0.05, 12))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "spread":
        x *= np.exp(rng.normal(size=(400, 1)) * 2)
    if kind == "ties":
        x = rng.integers(-1, 2, size=(400, 4)).astype(float)
    if kind == "negative":
        x = -np.abs(x)
        x[::2] = np.abs(x[::2])
    data = [(int(i), [float(a) for a in v]) for i, v in zip(rng.permutation(400), x)]
    assert run(spark, data) == brute(data, 5, 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, None), (10, [nan, 1.0]), (15, [inf, 1.0]), (20, [None, 1.0]), (None, [1.0, 1.0])]
    data += [(25, [0.0, 0.0]), (30, []), (35, [1.0]), (1, [1.0, 2.0, 4.0]), (2, [-3e30, 5e30]), (0, [0.5, 9.0])]
    got = run(spark, data)
    assert got == brute(data, 5, 3)
    assert {r[0] for r in got} == {0, 25, 30, 35}
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, [(0, None)]) == []


def test_scores_are_exact_beyond_doubles():
    q, v = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0]])
    assert K._exact(q, v)[0] == 2**60 + 3
    assert K._exact(q * 2.0**20, v)[0] == 2**63 - 1
