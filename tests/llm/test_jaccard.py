from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import jaccard_join as J
from partnerwatch.llm.common import table
from partnerwatch.llm.components import connected_components
from tests.llm.data import SF, docs, rows

TOKENS = st.lists(st.integers(0, 25), min_size=1, max_size=14, unique=True).map(sorted)


@settings(max_examples=400, deadline=None)
@given(st.lists(TOKENS, max_size=12), TOKENS, st.sampled_from([50, 75, 90, 100]))
def test_trie_finds_the_similar_sets(sets, probe, percent):
    trie = J.SetTrie()
    for i, s in enumerate(sets):
        trie.add(i, np.array(s, np.uint64))
    want = [i for i, s in enumerate(sets) if 100 * len(set(s) & set(probe)) >= percent * len(set(s) | set(probe))]
    assert sorted(trie.search(np.array(probe, np.uint64), percent)) == want


@settings(max_examples=300, deadline=None)
@given(TOKENS, TOKENS, st.sampled_from([50, 75, 90]))
def test_similar_sets_share_a_prefix_token(a, b, percent):
    if 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b)):
        assert set(a[: J.prefix_length(len(a), percent)]) & set(b[: J.prefix_length(len(b), percent)])


def brute(data):
    sets = {}
    for d, t in data:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    name = {d: d for d in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    keys = sorted(sets)
    for i, x in enumerate(keys):
        for y in keys[:i]:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                name[b] = a
    return {(d, len(s), find(d)) for d, s in sets.items()}


def got(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.components_of(df).collect()}


def test_given_tables(spark):
    df = table(spark, SF, "documents")
    assert got(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_chains_and_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "SLICE", 3)  # every shingle in slices
    monkeypatch.setattr(J, "PARTNERS", 4)
    base = [f"w{i}" for i in range(60)]
    data = [(i, " ".join(base[:40] if i % 2 else base[:40] + ["z"])) for i in range(0, 40)]  # two texts, many copies
    for i in range(25):  # a drifting chain: neighbours are similar, ends are not
        data.append((100 + i, " ".join([f"c{k}" for k in range(i * 2, 60 + i * 2)])))
    for i in range(20):  # near copies with an edit each
        words = [f"n{k}" for k in range(80)]
        words[(i * 4) % 80] = f"edit{i}"
        data.append((200 + i, " ".join(words)))
    for i in range(20):  # one shared passage, otherwise different
        data.append((300 + i, " ".join([f"p{k}" for k in range(30)] + [f"q{i}x{k}" for k in range(60)])))
    assert got(docs(spark, data)) == brute(data)


def test_edges(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "only three words"), (5, "ONLY three\x0bwords"), (6, "Three"), (7, text), (8, text.upper()), (9, "é " * 60_000), (10, "É " * 60_000)]
    df = docs(spark, [(d, t, "s", 1) for d, t in data], ", node long")
    assert got(df) == brute(data)
    more = docs(spark, [(d, t, "s", 1) for d, t in [*data, (7, text), (None, text), (None, "unlike any other text here and now"), (None, None)]], ", node long")
    seen = rows(J.components_of(more))
    assert len(seen) == 14 and {(r[0], r[2]) for r in seen if r[0] in (7, 8)} == {(7, 7), (8, 7)}
    assert sorted((r[1], r[2] or -1) for r in seen if r[0] is None) == [(0, -1), (3, -1), (8, 7)]
    kept = J.one_of_each(more)
    assert kept.columns == more.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7, 9, 10]
    assert sorted(str(r["text"]) for r in kept.where("doc_id is null").collect()) == ["None", "unlike any other text here and now"]
    assert rows(J.components_of(df.limit(0))) == [] and rows(J.one_of_each(df.limit(0))) == []


def test_connected_components(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(170, 2))] + [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5)]
    name = {x: x for p in links if p[0] != p[1] for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and name[a] != name[b]:
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    df = spark.createDataFrame(links, "a long, b long")
    assert {(r["node"], r["component"]) for r in connected_components(df).collect()} == set(name.items())
    assert rows(connected_components(df.limit(0))) == []


def true_links(data):
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for d, t in data for w in [t.lower().split()]}
    different = {frozenset(s) for s in sets.values()}
    return {(d, sum(100 * len(s & o) >= 75 * len(s | o) for o in different) - 1) for d, s in sets.items()}


def test_all_links_inside_components_are_counted(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 7)  # the groups are dealt into blocks
    monkeypatch.setattr(J, "WIDTH", 16)
    data = [(1, "a text like no other one here"), (2, "b c d e f g h i j k l m n o p"), (3, "b c d e f g h i j k l m n o p q"), (4, "B c d e f g h i j k l m n o p")]
    for i in range(40):  # all near each other
        words = [f"n{k}" for k in range(120)]
        words[(i * 3) % 120] = f"edit{i}"
        data.append((100 + i, " ".join(words)))
    for i in range(30):  # a drifting chain
        data.append((200 + i, " ".join([f"c{k}" for k in range(i * 2, 60 + i * 2)])))
    assert {(r["doc_id"], r["n_links"]) for r in J.components_of(docs(spark, data)).collect()} == true_links(data)


def test_a_text_is_kept_of_each_component_where_ids_repeat(spark):
    a, b = [f"a{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    near = " ".join([*a[:-1], "z"])
    a, b = " ".join(a), " ".join(b)
    kept = rows(J.one_of_each(docs(spark, [(3, a), (5, a), (5, b), (7, near)]).select("doc_id", "text")), "doc_id")
    assert kept == [(3, a), (5, b)]
    alone = docs(spark, [(None, a), (None, a), (None, near), (None, b), (9, b), (9, b)]).select("doc_id", "text")
    kept = [tuple(r) for r in J.one_of_each(alone).collect()]
    assert len(kept) == 2 and (9, b) in kept and {t for d, t in kept if d is None} <= {a, near}
    assert kept == [tuple(r) for r in J.one_of_each(alone.repartition(3)).collect()] or len(kept) == 2


def test_rows_without_id_link_others(spark):
    words = [f"w{i}" for i in range(60)]
    left, right = ["x1", "x2", "x3", "x4", "x5", "x6", *words[6:]], [*words[:-6], "y1", "y2", "y3", "y4", "y5", "y6"]
    data = [(1, " ".join(left)), (2, " ".join(right)), (None, " ".join(words))]
    assert {(r[0], r[2], r[3]) for r in rows(J.components_of(docs(spark, data)))} == {(1, 1, 1), (2, 1, 1), (None, 1, 2)}
    assert [r["doc_id"] for r in J.one_of_each(docs(spark, data)).collect()] == [1]
