from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import decontaminate as D
from partnerwatch.llm.common import table
from partnerwatch.llm.grams import WordHashes, ngrams
from tests.llm.data import SF, docs, rows


def brute_align(item, text):
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (D.MATCH if a == b else D.MISMATCH), h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
    return max(max(r) for r in h)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=15))
def test_alignment_scores_are_those_of_the_full_matrix(item, text):
    a, b = np.array(item, np.uint64), np.array(text, np.uint64)
    score, first, last = D.span(a, b)
    assert score == brute_align(item, text)
    if score:
        assert brute_align(item, text[first : last + 1]) == score


def item_text(rng, n=40):
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


def test_copies_edits_and_paraphrases_are_found_and_clean_texts_are_not(spark):
    rng = np.random.default_rng(5)
    items = [(i, item_text(rng)) for i in range(30)]
    filler = [item_text(rng, 200) for _ in range(30)]
    planted, clean = [], []
    for i, text in items:
        words = text.split()
        if i % 3 == 1:  # a fifth of the words replaced
            words = ["changed" if k % 5 == 0 else w.upper() + "," for k, w in enumerate(words)]
        if i % 3 == 2:  # words left out and put in
            words = [x for k, w in enumerate(words) if k % 7 for x in ([w, "extra"] if k % 6 == 0 else [w])]
        planted.append((i, filler[i][: 500 + i] + "\n" + " ".join(words) + " " + filler[i][500:]))
        clean.append((1000 + i, filler[i] + " " + " ".join(text.split()[:4])))
    hot = [(2000 + k, filler[k % 30] + " " + items[0][1]) for k in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminations(docs(spark, planted + clean + hot), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(30)} | {(d, 0) for d, _ in hot}
    exact = [r for r in got if r["item_id"] % 3 == 0]
    assert all(r["score"] == 1.0 and r["last_word"] - r["first_word"] == 39 for r in exact)


def test_found_on_the_given_tables_is_all_that_holds_an_item(spark):
    df, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    hashes = WordHashes(D.plain_word)
    items = {r["item_id"]: hashes.of(r["text"]).tobytes() for r in bench.collect()}
    texts = {r["doc_id"]: hashes.of(r["text"]).tobytes() for r in df.collect()}
    want = {(d, i) for d, t in texts.items() for i, w in items.items() if w in t}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.contaminations(df, bench).collect()}
    assert want <= set(got) and all(got[k] == 1.0 for k in want)
    leaked = {d for d, _ in got}
    assert {r["doc_id"] for r in D.clean_documents(df, bench).collect()} == set(texts) - leaked


@pytest.mark.parametrize("chars", [8_000_000, 60])
def test_edges(spark, monkeypatch, chars):
    monkeypatch.setattr(D, "BLOCK_CHARS", chars)
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "one two three four five six"), (3, None), (4, ""), (5, "!!! ..."), (2, "one two three four five six"), (6, "solo")], "item_id long, text string")
    data = [(1, None), (2, ""), (3, "x alpha, Beta y"), (4, "One two... three four five six"), (4, "One two... three four five six"), (None, "one two three four five six"), (7, "pad " * 60_000 + "one two three four five six " * 3), (8, "nothing here")]
    df = docs(spark, [(d, t, "s", "k") for d, t in data], ", item_id string")
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in D.contaminations(df, bench).collect()}
    assert got == {(3, 1, 1.0), (4, 2, 1.0), (None, 2, 1.0), (7, 2, 1.0)}
    clean = D.clean_documents(df, bench)
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 8]
    assert rows(D.contaminations(df.limit(0), bench)) == [] and rows(D.contaminations(df, bench.limit(0))) == []
    assert D.clean_documents(df, bench.limit(0)).count() == len(data)


def test_ngrams_name_runs_of_words():
    w = WordHashes().of("a b c a b c")
    g = ngrams(w, 3)
    assert len(g) == 4 and g[0] == g[3] and len(set(g.tolist())) == 3
    assert len(ngrams(w[:2], 3)) == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=12), st.lists(st.integers(0, 6), min_size=1, max_size=15))
def test_shared_words_bound_the_alignment(item, text):
    score = brute_align(item, text)
    assert score <= D.most_score(np.isin(item, text)) and score <= D.most_score(np.isin(text, item))


def test_edited_copies_are_found_beside_other_copies_of_the_item(spark):
    rng = np.random.default_rng(11)
    items = [(i, item_text(rng)) for i in range(4)]
    edited = [" ".join("changed" if k % 5 == 0 else w for k, w in enumerate(text.split())) for _, text in items]
    leaks = [(100 * i + k, item_text(rng, 60) + " " + items[i][1]) for i in range(3) for k in range((1, 2, 40)[i])]  # exact copies
    leaks += [(50 + 100 * i, item_text(rng, 60) + " " + edited[i]) for i in range(3)]  # and an edited one
    leaks += [(300 + k, item_text(rng, 60) + " " + edited[3]) for k in range(60)]  # equal edited copies only
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminations(docs(spark, leaks), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(d, d // 100) for d, _ in leaks}
