from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from partnerwatch.llm import runs as R
from partnerwatch.llm import stand_ins
from tests.llm.data import SF, docs, rows

PIECE = st.one_of(
    st.lists(st.integers(0, 3), max_size=5),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(3, 9), st.integers(0, 4)).map(lambda t: (t[0] * (t[1] + 1))[: len(t[0]) * t[1] + t[2]]),
)


def brute(x):
    """Every lag, every maximal stretch, by its definition."""
    found = []
    for q in range(1, len(x) // 4 + 1):
        k = 0
        while k + q < len(x):
            j = k
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            n = j - k + q
            own = x[k : k + n]
            if n >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                found.append((k, n, q))
            k = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECE, max_size=8).map(lambda p: sum(p, [])), st.sampled_from([1, 3, 256]))
def test_same_runs_as_by_definition(x, stall):
    before, R.STALL = R.STALL, stall
    try:
        assert R.runs_of(np.array(x, np.int64)) == brute(x)
    finally:
        R.STALL = before


def test_splitting_keeps_whole_runs_only():
    x = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 8, 5, 5, 5, 5, 5, 5, 7, 1, 2], np.int64)
    assert R.segments(x) == [(1, 9), (10, 16)]


@pytest.mark.parametrize("x", [np.zeros(200_000, np.int64), np.tile(np.arange(3000), 40), np.random.default_rng(0).integers(0, 2, 60_000)])
def test_long_texts(x):
    found = R.runs_of(x)
    for s, n, q in found[:50]:
        assert (x[s : s + n - q] == x[s + q : s + n]).all() and (s == 0 or x[s - 1] != x[s + q - 1]) and (s + n == len(x) or x[s + n] != x[s + n - q])
    if not x.any() or x.max() > 2:
        assert found == [(0, len(x), 1 if not x.any() else 3000)]


def damaged(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = damaged(doc_id, text)
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = best[1] and 1000 * best[1] // best[2]
    return doc_id, len(found), *best, milli, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_query_on_the_given_documents(spark):
    short = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len((r["text"] or "").split()) < 1500]
    got = {r[0]: tuple(r) for r in E.queries()["op11_periodic_runs"](spark, SF).collect()}
    want = [expected(r["doc_id"], r["text"]) for r in short]
    assert len(want) > 100 and any(w[1] for w in want)
    assert [got[w[0]] for w in want] == want


def test_edges(spark):
    odd = "a\xa0b a\xa0b a\xa0b a\xa0b\ta\xa0b a\xa0b"
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "x y " * 5 + "x"), (4, "x y " * 5 + "x"), (None, odd), (5, "A a A a A a a a"), (6, "q " * 50_000), (7, "m n o " * 4 + "m n o m o " * 2)]
    df = docs(spark, [(d, t, "s", 1, "z") for d, t in data], ", runs int, strongest string")
    found = R.periodic_runs(df)
    assert found.columns == ["doc_id", "runs", "strongest", "collapsed"]
    told = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in found.collect()}
    assert told[4, "x y"] == [(0, 11, 2)] and told[None, "a\xa0b"] == [(0, 6, 1)] and told[6, "q"] == [(0, 50_000, 1)]
    assert told[1, ""] == told[2, ""] == told[3, ""] == []
    assert told[5, "A a A a A a a a"] == [] and [k for k in told if k[0] == 7] == [(7, "m n o o m n o m o")]
    assert rows(R.periodic_runs(df.limit(0))) == []


def test_ties_go_to_the_first_run():
    x = np.array([1] * 6 + [0] + [2] * 6 + [0] + [3, 4] * 6, np.int64)
    assert R.strongest(R.runs_of(x)) == (0, 6, 1)


def test_tails_repeat_by_the_rule(spark):
    data = [(i, " ".join(f"w{k}" for k in range(i % 90))) for i in range(400)] + [(None, "a b"), (77, None)]
    got = stand_ins.with_repeating_tails(docs(spark, data)).select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0)).alias("w"))
    assert {r["doc_id"]: r["w"] for r in got.collect()} == {d: [w.decode() for w in damaged(d, t)] for d, t in data}
