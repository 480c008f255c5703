from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

import __spark_entry__ as E
from partnerwatch.llm import repair as C
from partnerwatch.llm import stand_ins
from tests.llm.data import SF, rows

SCHEMA = "conv_id long, turn long, role string, text string, cost int"
RULE = re.compile("(s?(ua)+)?")


def cheapest(symbols):
    """Least (cost, audit) by trying edits row by row; states are role letters so far, folded by the rule's automaton."""
    best = {(0, ""): (0, "")}  # (rows read, last letter) -> (cost, audit)

    def offer(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value
            return True
        return False

    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    todo = [(0, "")]
    while todo:
        i, last = todo.pop()
        cost, audit = best[i, last]
        moves = [(i, x, 2, "I") for x in "ua" if x in follows[last]]
        if i < len(symbols):
            role, fault = symbols[i]
            moves.append((i + 1, last, 3, "D"))
            if fault not in "bd":
                late = fault == "t"
                moves += [(i + 1, x, 2 + late, "R") for x in "ua" if x in follows[last]]
                if role in follows[last] and role:
                    moves.append((i + 1, role, late, "K"))
        for j, x, more, edit in moves:
            if offer(best, (j, x), (cost + more, audit + edit)):
                todo.append((j, x))
    return min(best[k] for k in best if k[0] == len(symbols) and k[1] in ("", "a"))


def by_grammar(words, block):
    grammar, fold_of = C.Grammar(), []
    cut = [[w[i : i + block] for i in range(0, len(w), block)] for w in words]
    matrices = grammar.evaluate(sorted({b for w in cut for b in w}))
    for w, blocks in zip(words, cut):
        fold = C.Fold()
        for b in blocks:
            m = matrices[b]
            fold.add("u" * len(b), "-" * len(b), [x and x[0] for r in m for x in r], [x and C.flat(x[1]) for r in m for x in r])
        fold_of.append(fold.row(None)[5:])
    return fold_of


def symbol(role, fault):
    return "D" if fault in "bd" else role.upper() if fault == "t" else role


@pytest.mark.parametrize("block", [1, 3, 256])
def test_grammar_gives_the_cheapest_least_edits(block):
    rng, cases = random.Random(block), []
    for n in range(4):
        cases += [list(c) for c in itertools.product([("s", "-"), ("u", "-"), ("a", "t"), ("o", "-"), ("u", "d")], repeat=n)]
    cases += [[(rng.choice("suuaao"), rng.choice("----tb")) for _ in range(rng.randint(0, 40))] for _ in range(200)]
    words = ["".join(symbol(*s) for s in c) for c in cases]
    assert by_grammar(words, block) == [cheapest(c) for c in cases]


def test_rules_are_shared_and_found():
    grammar = C.Grammar()
    words = [[grammar.symbol(c) for c in "uauauauaD"], [grammar.symbol(c) for c in "suauauaua"]]
    grammar.compress(words)
    assert len(words[0]) < 9 and len(words[1]) < 9 and len(grammar.matrices) > 4
    before = len(grammar.matrices)
    grammar.evaluate(["uaua"])
    assert len(grammar.matrices) <= before + 1


def test_ropes():
    rng = random.Random(1)
    for _ in range(500):
        parts = [["".join(rng.choice("DIKR") for _ in range(rng.choice([0, 1, 40, 70]))) for _ in range(4)] for _ in range(2)]
        a, b = (C.joined(C.joined(p[0], p[1]), C.joined(p[2], p[3])) for p in parts)
        assert C.flat(a) == "".join(parts[0]) and C.less(a, b) == ("".join(parts[0]) < "".join(parts[1]))


def damaged(data):
    out = []
    for conv, turn, role, text in data:
        told = [" " if x is None else x for x in (conv, turn, role, text)]
        fate = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = "user" if fate == 4 else told[2], "" if fate == 1 else re.sub("[.!?]", "", told[3]) if fate == 2 else told[3]
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def judged(data):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)."""
    out = {}
    for conv in {r[0] for r in data}:
        own = sorted((r[1:] for r in data if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), ""
        for _, role, text in own:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults += "b" if not words else "d" if (role, text) in seen else "-" if words[-1] in ".!?" else "t"
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        letters = [r[1][:1] for r in own]
        cost, audit = cheapest([(x if x in ("s", "u", "a") else "o", f) for x, f in zip(letters, faults)])
        at, written = 0, []
        for edit in audit:
            want = "assistant" if written and written[-1][0][0] == "u" else "user"
            if edit == "I":
                written.append((want, ""))
                continue
            if edit != "D":
                written.append((own[at][1] if edit == "K" else want, own[at][2]))
            at += 1
        assert RULE.fullmatch("".join(r[0] for r, _ in written))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
        text = "\n".join(f"{r}:{t}" for r, t in written)
        out[conv] = (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def run(frame):
    placed = C.placed_rows(frame)
    found = C.diagnoses(placed)
    gaps = {r[0]: r[1] for r in C.turn_gaps(placed).collect()}
    hashes = {r[0]: r[1] for r in C.digests(C.repaired_turns(placed, found)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r[0]: (gaps[r[0]], *tuple(r)[1:], hashes.get(r[0], empty)) for r in found.collect()}


def test_given_conversations(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    data = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    want = judged(damaged(data))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r)[1:] for r in E.queries()["op13_conversation_repair"](spark, SF).collect()}
    assert got == {c: want.get(c, nothing) for c in {d[0] for d in data}}
    assert sorted(map(str, rows(stand_ins.damaged_turns(table)))) == sorted(map(str, damaged(data)))


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 7)  # long conversations lie in many blocks
    rng = random.Random(4)
    data = [(1, None, "user", "Hello?"), (1, None, "assistant", "Yes."), (1, 3, "user", "x"), (1, 9, None, None), (2, 5, "", "a."), (2, 5, "tool", "b."), (2, 5, "tool", "b.")]
    data += [(None, 1, "user", "Who?"), (None, 2, "assistant", "Me. \t"), (3, 1, "assistant", "\xa0"), (4, None, "system", "s."), (5, 1, "system", "Be nice.")]
    data += [(6, i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Fine.", "No", "", f"text {i}."])) for i in range(300)]
    data += [(7, i, "user", "same.") for i in range(200)] + [(8, 1, "user", "w " * 60_000), (8, 2, "assistant", "w " * 60_000 + ".")]
    frame = spark.createDataFrame([(*r, 1) for r in data], SCHEMA).repartition(5)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]
    assert run(frame) == judged(plain)
    placed = C.placed_rows(frame.limit(0))
    assert rows(C.diagnoses(placed)) == [] and rows(C.repaired_turns(placed, C.diagnoses(placed))) == []
