"""Best-fit packing: best-fit decreasing over a segment tree of capacities.

1. Texts are encoded where they lie, each with an end id, and cut into pieces:
   documents longer than the capacity into pieces of exactly the capacity, the
   first one holding what is left over; others are one piece. A task numbers its
   pieces of each length.
2. Best-fit decreasing only sees lengths, and pieces of one length are alike: so
   it runs over the counts of the lengths, at most ``CAPACITY`` numbers whatever
   the corpus. Open sequences are kept by the room they have left; a segment
   tree over the rooms finds the tightest one that holds a length in logarithmic
   time. All pieces of a length that go to sequences of equal room are one step:
   (length, first rank, sequences, how many pieces each, place in them). Steps
   number some thousands, and ``CAPACITY`` squared at most.
3. A piece's rank among those of its length is its number in its task plus the
   counts of the tasks before, added up by a window over (length, task) counts.
   Its step is found by binary search and gives sequence and place by
   arithmetic; the steps are the only table sent to the tasks.

No piece is moved to be packed. ``sequences`` then brings the pieces of each
sequence together, at most ``CAPACITY`` ids in a group.

Best-fit decreasing needs at most 11/9 of the fewest possible sequences plus
one; that they are the fewest is sure where they equal the ids over the capacity,
rounded up.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each, also with one doc_id, and rows without one too; ties between equal
lengths go by task, then by the order in it, between sequences of equal room to
those opened first; a text of any length is cut, not shortened; an empty table
gives an empty result. Further columns are left out.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, shared_table, small_batches

CAPACITY, END_ID = 1024, 2
RANKS = 1 << 48  # more pieces of one length than any table has
PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, nth long"


def ids_bytes(ids: list[int]) -> bytes:
    """Unsigned 32-bit integers, little-endian."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def token_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level BPE vocabulary stands for:
    printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    """ids of whole texts by a byte-level BPE tokenizer file, as little-endian
    unsigned 32-bit integers.

    The vocabulary is the file's, as ``tokenizers`` reads it. Texts of Latin-1
    characters, without the beginning of a special token, are merged by
    ``tiktoken`` from the same vocabulary, which is three times as fast, if its ids
    for ``PROBES`` are those of ``tokenizers``; all others by ``tokenizers``.
    """

    PROBES = (
        "the The,  ÉTÉ &&& straße.\n\nÀ x", "a  b   c \n d\n\n\ne", "it's I'LL we've 12a3 ñandú|ÿ", " \t x y ", "don't.'s\n's \x85\xa0 \x1c", "¼² ªº µ×÷ \r\n \x00",
    )

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = None
        letters = token_bytes()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        try:
            ranks = {bytes([letters[c] for c in t]): i for t, i in self.tokenizer.get_vocab().items() if t not in special}
            fast = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            if all(fast.encode_ordinary(t) == self._ids(t) for t in self.PROBES):
                self.fast, self.marks = fast, {t[:2] for t in special}
        except (KeyError, ValueError):  # not a byte-level vocabulary
            pass

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if self.fast and not any(m in text for m in self.marks):
            try:
                text.encode("latin-1")
                return ids_bytes(self.fast.encode_ordinary(text))
            except UnicodeEncodeError:
                pass
        return ids_bytes(self._ids(text))


@cache
def encoder(path: str) -> ByteEncoder:
    """One encoder for each Python worker, kept between its tasks."""
    return ByteEncoder(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids of all pieces, and their task and number
    among those of a length in it; written once to the shared folder."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, enc, end = TaskContext.get().partitionId(), encoder(tokenizer), ids_bytes([end_id])
        seen = np.zeros(capacity + 1, np.int64)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
        names = [c.split()[0] for c in PIECES.split(", ")]
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"]):
                ids = enc.encode(text.as_py() or "") + end
                for i, (at, n) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((doc_id, i, at, n, ids[4 * at : 4 * (at + n)], task, int(seen[n])))
                    seen[n] += 1
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names)
        give_back()

    return shared_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES), "pieces")


class RoomTree:
    """A segment tree over rooms 0 to ``capacity``: which have open sequences."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.size)

    def mark(self, room: int, some: bool) -> None:
        i = room + self.size
        self.some[i] = some
        while i > 1:
            i >>= 1
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def tightest(self, least: int) -> int:
        """The smallest room of ``least`` at least that has open sequences, else -1."""
        i = least + self.size
        if self.some[i]:
            return least
        while i > 1:
            if not i & 1 and self.some[i + 1]:  # to the right of the way up
                i += 1
                while i < self.size:
                    i = 2 * i + (not self.some[2 * i])
                return i - self.size
            i >>= 1
        return -1


def best_fit(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing of ``counts[length]`` pieces. Steps (length, first
    rank, first sequence, pieces of a sequence, place in it), by length and rank,
    and the number of sequences."""
    tree, open_, steps, n_sequences = RoomTree(capacity), [[] for _ in range(capacity + 1)], [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_[room].append((first, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room < 0:  # no open sequence holds it: as many new ones as the rest needs
                n = -(-left // (capacity // length))
                room, first, n_sequences = capacity, n_sequences, n_sequences + n
            else:
                first, n = open_[room].pop(0)
                if not open_[room]:
                    tree.mark(room, False)
            each = room // length
            steps.append((length, rank, first, each, capacity - room))
            full = min(n, left // each)
            part = left - full * each if full < n else 0
            put(room - each * length, first, full)
            if part:
                put(room - part * length, first + full, 1)
            put(room, first + full + (part > 0), n - full - (part > 0))
            taken = full * each + part
            rank, left = rank + taken, left - taken
    return np.array(sorted(steps), np.int64).reshape(-1, 5), n_sequences


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece."""
    cut = pieces(docs, tokenizer, capacity, end_id)
    held = shared_table(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(best_fit(counts, capacity)[0])

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        steps, n, rank = sent.value, lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        own = steps[np.searchsorted(steps[:, 0] * RANKS + steps[:, 1], n * RANKS + rank, side="right") - 1]
        rank = rank - own[:, 1]
        return pd.DataFrame({"sequence_id": own[:, 2] + rank // own[:, 3], "offset": own[:, 4] + rank % own[:, 3] * n})

    placed = cut.join(first, ["length", "task"]).withColumn("at", place("length", F.col("nth") + F.col("before")))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids, starts (where each piece begins) and ids (binary) of
    every packed sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("p"))
    return grouped.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"), F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"))
