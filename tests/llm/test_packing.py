from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from partnerwatch.llm import packing as K
from partnerwatch.llm.queries import BYTE_TOKENIZER, tokenizer_path
from tests.llm.data import SF, docs, rows

PATH = tokenizer_path(BYTE_TOKENIZER)


def plain_best_fit(counts, capacity):
    """Rooms that are left after best-fit decreasing, one piece at a time."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else capacity) - length)
    return sorted(rooms)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 80).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 12), max_size=14))))
def test_best_fit_decreasing_by_counts_is_that_by_pieces(case):
    capacity, counts = case
    steps, n = K.best_fit(counts, capacity)
    held = defaultdict(list)
    for length, count in counts.items():
        own = steps[steps[:, 0] == length]
        for rank in range(count):
            s = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            held[int(s[2] + (rank - s[1]) // s[3])].append((int(s[4] + (rank - s[1]) % s[3] * length), length))
    rooms = []
    for parts in held.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(x for _, x in parts[:i]) for i in range(len(parts))]
        rooms.append(capacity - sum(x for _, x in parts))
    assert sorted(held) == list(range(n)) and sorted(rooms) == plain_best_fit(counts, capacity)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 70)), st.integers(0, 70))
def test_tree_finds_the_tightest_room(rooms, least):
    tree = K.RoomTree(70)
    for r in range(71):
        tree.mark(r, True)
    for r in range(71):
        tree.mark(r, r in rooms)
    assert tree.tightest(least) == min((r for r in rooms if r >= least), default=-1)


def test_encoder_gives_the_tokenizers_ids():
    enc, rng = K.ByteEncoder(PATH), random.Random(0)
    assert enc.fast
    parts = [*"ab é\n\t.,'É1\x85中|<>-\xa0²µ\x00\r", "the", "'s", "n't", "  ", "\n ", "ß", "<|endoftext|>", " word"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert enc.encode(text) == K.ids_bytes(enc.tokenizer.encode(text, add_special_tokens=False).ids), text


def test_cuts():
    assert K.cuts(1, 4) == [(0, 1)] and K.cuts(4, 4) == [(0, 4)] and K.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def check(packed, source, capacity=1024):
    """Every document's ids come back, cut as stated, in gapless sequences."""
    enc, by_doc, by_sequence = K.ByteEncoder(PATH), defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] * 4 == len(r["ids"])
    want = defaultdict(list)
    for d, t in source:
        want[d].append(enc.encode(t or "") + K.ids_bytes([2]))
    assert by_doc.keys() == want.keys()
    for d, texts in want.items():
        got = sorted((r["start"], r["piece"], bytes(r["ids"])) for r in by_doc[d])
        assert got == sorted((at, i, x[4 * at : 4 * (at + n)]) for x in texts for i, (at, n) in enumerate(K.cuts(len(x) // 4, capacity)))
    for parts in by_sequence.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    lengths = defaultdict(int)
    for parts in by_sequence.values():
        for _, n in parts:
            lengths[n] += 1
    assert len(by_sequence) == len(plain_best_fit(lengths, capacity))
    return by_sequence


def test_given_documents(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    packed = K.pack(source, PATH).cache()
    found = check(packed, [(r["doc_id"], r["text"]) for r in source.collect()])
    total = sum(n for parts in found.values() for _, n in parts)
    assert len(found) <= 11 / 9 * -(-total // 1024) + 1
    told = {(r["doc_id"], r["piece"]): r for r in E.queries()["op12_best_fit_packing"](spark, SF).collect()}
    assert all(told[r["doc_id"], r["piece"]]["ids_crc32"] == zlib.crc32(r["ids"]) for r in packed.collect())
    whole = {r["sequence_id"]: r for r in K.sequences(packed).collect()}
    for r in packed.collect():
        s = whole[r["sequence_id"]]
        assert bytes(s["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
        assert r["doc_id"] in s["doc_ids"] and r["offset"] in s["starts"]


def test_edges(spark):
    data = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "c"), (None, "x"), (None, None), (4, "word " * 6000), (5, "é中" * 100), (6, "<|endoftext|> a")]
    df = docs(spark, [(d, t, "s", 1, 2) for d, t in data], ", piece int, ids string").repartition(3)
    packed = K.pack(df, PATH, capacity=64)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    check(packed, data, 64)
    assert rows(K.pack(df.limit(0), PATH)) == []
