"""Chat formatting with a grammar round trip.

A conversation is rendered as

    conversation = turn*
    turn         = "### " name ": " body "\\n</turn>\\n"
    name         = "User" | "Assistant" | "System" | "=" percent-coded role

and a deterministic parser reads it back: a control string (``###`` or
``</turn>``) with no backslash before it ends or starts something; a run of
backslashes before a control string inside a body loses one of them. Each turn
is rendered as it is, reparsed, and compared with its source; if they differ,
the conflicting control strings get a backslash and the turn is rendered
again, until the reparsed turn is identical. The result is one row for each
turn, ``piece``; the pieces of a conversation joined in order are its text.

Rendering works row by row. Turns meet only in a sort by conversation, whose
rows are then numbered one at a time; so a conversation of any length holds
one Arrow batch in memory.

Defined results: a null text is empty; a null role is the empty role; rows
without conv_id are one conversation; turns order by turn (null first), then
role, text; repeated rows are turns of their own. An empty table gives an
empty result. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import small_batches

NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}
_ROLES = {v: k for k, v in NAMES.items()}
_END = "\n</turn>\n"
_CONTROL = re.compile(r"(?<!\\)(\\*+)(###|</turn>)")
_HEADER = re.compile(r"### (User|Assistant|System|=[A-Za-z0-9_.~%-]*): ")
FORMATTED = "conv_id long, position long, role string, piece string, piece_start long, loss_start long, loss_end long"


class GrammarError(ValueError):
    """The text is not a rendered conversation."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def _drop_one(m: re.Match) -> str:
    if not m[1]:
        raise GrammarError(f"control string {m[2]!r} inside a text")
    return m[1][1:] + m[2]


def unescape(body: str) -> str:
    return _CONTROL.sub(_drop_one, body)


def _render(name: str, body: str) -> str:
    return f"### {name}: {body}{_END}"


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the body."""
    at = 0
    while at < len(text):
        header = _HEADER.match(text, at)
        if not header:
            raise GrammarError(f"no turn starts at {at}")
        end = next((m.start(2) for m in _CONTROL.finditer(text, header.end()) if not m[1]), -1)
        if end < 1 or not text.startswith(_END, end - 1) or end - 1 < header.end():
            raise GrammarError(f"the turn at {at} has no end")
        name = header[1]
        role = unquote(name[1:]) if name[0] == "=" else _ROLES[name]
        yield role, unescape(text[header.end() : end - 1]), header.end(), end - 1
        at = end - 1 + len(_END)


def render_turn(role: str, text: str) -> str:
    """The piece of one turn: escaped only if it does not read back as it is."""
    name = NAMES.get(role) or "=" + quote(role, safe="")
    for body in (text, escape(text)):
        piece = _render(name, body)
        try:
            if [t[:2] for t in parse(piece)] == [(role, text)]:
                return piece
        except GrammarError:
            pass
    raise GrammarError(f"no rendering of {text[:80]!r} reads back")


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pieces = [render_turn(r, t) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist())]
        yield pa.record_batch([b["conv_id"], b["turn"], b["role"], pa.array(pieces, pa.string())], ["conv_id", "turn", "role", "piece"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation; its rows arrive in order."""
    last: object = ()
    position = start = 0
    for b in batches:
        ids, rows = b["conv_id"].to_pylist(), []
        for conv, role, piece in zip(ids, b["role"].to_pylist(), b["piece"].to_pylist()):
            if conv != last:
                last, position, start = conv, 0, 0
            _, _, first, end = next(parse(piece))
            loss = (start + first, start + end) if role == "assistant" else (None, None)
            rows.append((position, start, *loss))
            position, start = position + 1, start + len(piece)
        columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], [], []))]
        yield pa.record_batch([b["conv_id"], columns[0], b["role"], b["piece"], *columns[1:]], [c.split()[0] for c in FORMATTED.split(", ")])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row for each turn: its piece of the conversation's text, where the
    piece starts, and the bounds of its body where loss is taken (assistants)."""
    small_batches(turns.sparkSession)
    clean = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")),
    )
    pieces = clean.mapInArrow(_rendered, "conv_id long, turn long, role string, piece string")
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "piece").mapInArrow(_placed, FORMATTED)


class _Digest:
    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, loss: bool) -> None:
        self.chars += len(piece)
        for role, text, _, _ in parse(piece):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if loss:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self, conv: object) -> tuple:
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [c.split() for c in DIGESTS.split(", ")]
    schema = pa.schema([(n, pa.int64() if kind == "long" else pa.string()) for n, kind in fields])
    frame = lambda rows: pa.record_batch(list(zip(*rows)) or [[]] * len(fields), schema=schema)
    last, digest = None, None
    for b in batches:
        rows = []
        for conv, position, piece, loss in zip(*(b[c].to_pylist() for c in ("conv_id", "position", "piece", "loss_start"))):
            if position == 0:
                if digest:
                    rows.append(digest.row(last))
                last, digest = conv, _Digest()
            digest.add(piece, loss is not None)
        yield frame(rows)
    if digest:
        yield frame([digest.row(last)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed back from its formatted pieces. It
    relies on the order that ``format_conversations`` leaves in each partition."""
    return formatted.mapInArrow(_digests, DIGESTS)
