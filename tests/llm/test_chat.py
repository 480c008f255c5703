from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import chat as C
from tests.llm.data import rows

PARTS = ["###", "#", "</turn>", "\n", "\\", "### User: ", "### Assistant: ", "a", "</", "turn>", " ", "é", "=", "%"]
TEXT = st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PARTS), max_size=12).map("".join))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=6))
def test_conversations_read_back_identical(turns):
    text = "".join(C.render_turn(r, t) for r, t in turns)
    assert [t[:2] for t in C.parse(text)] == turns


def test_plain_turns_are_not_escaped_and_bad_text_is_refused():
    assert C.render_turn("user", "a # b \\ c") == "### User: a # b \\ c\n</turn>\n"
    assert C.render_turn("assistant", r"\### x") == "### Assistant: \\\\### x\n</turn>\n"
    for bad in ("x", "### User: a", "### User: a ### b\n</turn>\n", "### Nobody: a\n</turn>\n"):
        with pytest.raises(C.GrammarError):
            list(C.parse(bad))


def brute(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        text = "".join(C.render_turn(r, x) for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (conv, len(own), sha("".join(f"{r}\n{x}\n" for _, _, r, x in own)), len(loss), sha(loss), len(text))
    return out


def test_digests_match_brute_force_with_edges(spark):
    text = r"\### Assistant: </turn> ok"
    turns = [(-7, 0, "user", text), (-7, 1, "assistant", text), (1, 1, "assistant", None), (1, 0, None, "a"), (1, None, "tool\n:", "b"), (None, 3, "user", "x"), (None, 2, "assistant", "y" * 200_000)]
    turns += [(2, 5, "user", "same")] * 3 + [(3, i, "assistant", "") for i in range(500)] + [(2**60 + 1, 0, "user", "big id")]
    df = spark.createDataFrame([(*t, "p") for t in turns], "conv_id long, turn long, role string, text string, piece string")
    out = C.format_conversations(df)
    assert {r["conv_id"]: tuple(r) for r in C.read_back(out).collect()} == brute(turns)
    for conv in (-7, 1, 2):
        pieces = [r for r in out.where(f"conv_id = {conv}").collect()]
        whole = "".join(r["piece"] for r in sorted(pieces, key=lambda r: r["position"]))
        for r in pieces:
            assert whole[r["piece_start"] :].startswith(r["piece"])
            if r["loss_start"] is not None:
                body = C.unescape(whole[r["loss_start"] : r["loss_end"]])
                assert (r["role"], body) == ("assistant", text if conv == -7 else "")
    assert rows(C.read_back(C.format_conversations(df.limit(0)))) == []
