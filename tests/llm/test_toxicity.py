from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import toxicity as T
from partnerwatch.llm.common import table
from tests.llm.data import docs, rows

SF = "/root/testdata/sf0.1"


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition: the best (shortest,
    first) segment, then what is left and right of it."""
    best, at = 0, None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best or (total == best and at and j - i < at[1] - at[0]):
                best, at = total, (i, j)
    if at is None:
        return []
    i, j = at
    return brute_segments(scores[:i]) + [(i, j, best)] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1 :])]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(1, 6)), max_size=30), st.sampled_from([1, 2, 3]))
def test_segments_are_the_maximal_ones(marks, drift):
    # odd multiples keep sums distinct from zero often; ties keep the same scores
    tokens = [(i, float(s)) for i, s in enumerate(marks) if s]
    got = T.maximal_segments(tokens, -float(drift))
    want = brute_segments([s if s else -drift for s in marks])
    assert sorted(s for *_, s in got) == sorted(float(s) for *_, s in want)
    for a, b, s in got:
        assert sum(marks[i] if marks[i] else -drift for i in range(a, b + 1)) == s


def test_search_is_linear_in_the_text():
    tokens = [(i, 1.0 + (i % 3)) for i in range(0, 400_000, 2)]
    assert T.maximal_segments(tokens, -1.5)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    got = T.score_documents(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    toxic = [r for r in held if labels[r["doc_id"]]]
    assert len(got) == 10_000
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_passages_lie_where_the_words_are():
    bad = {b: 6.0 for b in T.buckets("awful")}
    model = T.ToxicityModel(bad, rate=1.0, k=0.01, intercept=-3.0, slope=2.0)
    text = "fine " * 300 + "awful, you AWFUL awful! " + "fine " * 300 + "awful awful awful"
    found = model.passages(text, T._Kept(model.token_score))
    assert [(a, b) for a, b, _ in found] == [(300, 303), (604, 606)]
    assert model.score(model.evidence(text, T._Kept(model.token_score))) > 0.9
    assert model.evidence("", T._Kept(model.token_score)) == 0.0


def test_edges(spark):
    data = [(i, f"{'nasty brute ' * 3 if i % 3 == 0 else ''}word{i} and other plain words here", "s", "k") for i in range(300)]
    data += [(None, "nasty brute", "s", "k"), (900, None, "s", "k"), (901, "", "s", "k"), (902, "plain " * 60_000, "s", "k"), (902, "nasty brute nasty brute", "s", "k")]
    df = docs(spark, data, ", passages string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = T.score_documents(df, labels).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["predicted"])
    assert all(by[i] == [int(i % 3 == 0)] for i in range(300))
    assert by[None] == [1] and by[900] == by[901] == [0] and sorted(by[902]) == [0, 1]
    none = labels.limit(0)
    assert all(r["predicted"] == 0 and r["score"] < 1e-6 for r in T.score_documents(df, none).collect())
    assert rows(T.score_documents(df.limit(0), labels)) == []


def test_lambda_solves_its_equation():
    model = T._extreme_values(T.ToxicityModel({1: 4.0, 2: 6.0}), 100_000.0, {4.0: 20}, 20)
    s, p = [4.0] * 20 + [6.0], 21 / 100_000
    assert abs((1 - p) * math.exp(model.rate * T.DRIFT) + p * sum(math.exp(model.rate * x) for x in s) / 21 - 1) < 1e-6
