from __future__ import annotations

from collections import Counter

import pytest

from partnerwatch.llm import mixing as M
from tests.llm.data import docs, rows


def brute_targets(sizes: dict, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = sum(w[s] for s in names if s not in full)
        level = (total - sum(most * sizes[s] for s in full)) / left if left else 0
        more = {s for s in names if s not in full and most * sizes[s] < level * w[s]}
        if not more:
            return {s: most * sizes[s] if s in full else level * w[s] for s in names}
        full |= more


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1, "Z": 500}, {"a": 100, None: 1}, {"é": 7, "z": 9, "a": 0, None: 1000, "y": 3}])
def test_targets_match_the_reshared_ones(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want)


def test_mix_emits_what_the_plan_takes(spark):
    table = [(i, "w " * (i % 7 + 1), f"s{i % 5}") for i in range(400)]
    df = docs(spark, table)
    plan = {r["doc_id"]: r for r in M.mix_plan(df).collect()}
    out = Counter(r["doc_id"] for r in M.mix(df).collect())
    assert all(out.get(d, 0) == r["copies"] <= 3 for d, r in plan.items())
    assert M.mix(df).columns == df.columns
    assert rows(M.mix_plan(df), "doc_id") == rows(M.mix_plan(df.repartition(3)), "doc_id")
    for s in {r["source"] for r in plan.values()}:
        own = [r for r in plan.values() if r["source"] == s]
        taken, target = sum(r["size"] * r["copies"] for r in own), own[0]["target"]
        assert abs(taken - target) < 0.25 * target


def test_edges(spark):
    df = docs(spark, [(1, None, None, "x"), (1, "", None, "x"), (None, "a\x0bb\x1fc d", "s", "y"), (None, " \t", "s", "z"), (7, "a" * 100_000, "s", "t"), (8, "a\xa0b", "s", "t")], ", __size string")
    got = M.mix_plan(df).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 0, 1, 1, 3]
    assert all(r["copies"] == 0 for r in got if r["source"] is None)
    clash = docs(spark, [(1, "a b", "s", 5, "q")], ", size long, target string")
    assert [r["target"] for r in M.mix(clash).collect()] == ["q"]
    assert rows(M.mix_plan(df.limit(0))) == [] and rows(M.mix(df.limit(0))) == []
    empty = docs(spark, [(1, None), (2, "")])
    assert [(r["target"], r["copies"]) for r in M.mix_plan(empty).collect()] == [(0.0, 0)] * 2


def test_equal_rows_have_coins_of_their_own(spark):
    same = [(7, "one two three", "a")] * 900 + [(None, "four five", "a")] * 300 + [(i, "six", "b") for i in range(5000, 6200)]
    df = docs(spark, same).repartition(7)
    plan = M.mix_plan(df).collect()
    for source in "ab":
        own = [r for r in plan if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) < 0.1 * own[0]["target"]
    told = Counter((r["doc_id"], r["size"], r["copies"]) for r in plan)
    assert told == Counter((r["doc_id"], r["size"], r["copies"]) for r in M.mix_plan(df.repartition(3)).collect())
    out = Counter((r["doc_id"], r["text"]) for r in M.mix(df).collect())
    for doc_id, text, size in ((7, "one two three", 3), (None, "four five", 2)):
        assert out[doc_id, text] == sum(n * copies for (d, s, copies), n in told.items() if d == doc_id and s == size)
