"""Conversation structure repair: a grammar-compressed dynamic program.

Rows of a conversation are ordered by turn (null first), then role, text. Each
has a role class (the first letter of the role: s, u, a, or another) and at most
one fault: blank (nothing but white space), duplicate (role and text seen
earlier), truncated (the last character that is not white space is none of
``.!?``). Edits give a conversation the role letters ``(s?(ua)+)?`` at the least
cost: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of blank and
duplicate rows), Insert an empty user or assistant row 2; a truncated row that is
not deleted adds 1. Of the cheapest lists of edits the ASCII-least stands, written
as their initials (the audit).

A row is a 4 x 4 matrix over the states of that pattern (start, after s, after u,
after a); an entry is the cheapest (cost, audit) from one state to another, inserts
behind the row included. Matrices multiply in the min-plus sense; concatenation
keeps the order of audits of equal cost, since an audit tells its edits and with
its start the state it ends in. So:

1. Rows are sorted once, by ranges of (conversation, turn), so one conversation of
   any length lies in many tasks. Duplicates are found by the first place of each
   (conversation, hash of role and text), a pre-aggregated table.
2. Each conversation is cut into blocks of at most ``BLOCK`` symbols (role class
   and fault). A task compresses the distinct blocks of a batch together by
   Re-Pair: the most frequent pair of symbols becomes a rule until none is
   frequent. Every rule has one matrix, the product of its two parts', made once
   for all conversations that hold it and kept for later batches; audits are ropes
   that share those of the parts.
3. The blocks of a conversation are folded in order, from the start state: four
   (cost, audit) entries, whose common beginning is set aside at once.
4. The audit meets the rows in one more sort by conversation, and a stream applies
   its edits; a conversation is never held whole, but for its audit (a byte a row).

Defined results: null roles and texts count as one space; rows without conv_id are
one conversation; equal rows are duplicates of the first; a turn may be null or
repeat; a conversation without rows is in no result here; texts of any length are
whole; an empty table gives an empty result. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, row_number_columns, shared_table, small_batches

BLOCK = 256  # rows of one matrix at most
MOST_RULES = 20_000  # rules and blocks that a task remembers between its batches
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
LEGAL = {"su", "ua", "au"}
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
WORD = r"[^\x20\x09-\x0D]"

#: A rope is a string or a pair of ropes; a matrix has rows of (cost, rope) or None.
Rope = str | tuple
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def leaves(rope: Rope) -> Iterator[str]:
    """The strings of a rope, from left to right."""
    stack = [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            yield x
        else:
            stack += [x[1], x[0]]


def flat(rope: Rope) -> str:
    return rope if isinstance(rope, str) else "".join(leaves(rope))


def joined(a: Rope, b: Rope) -> Rope:
    if not a or not b:
        return b or a
    short = isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64
    return a + b if short else (a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether ``a`` stands before ``b`` in ASCII order."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    x, y, left, right = leaves(a), leaves(b), "", ""
    while True:
        left, right = left or next(x, ""), right or next(y, "")
        n = min(len(left), len(right))
        if not n:
            return not left and bool(right)
        if left[:n] != right[:n]:
            return left[:n] < right[:n]
        left, right = left[n:], right[n:]


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i, row in enumerate(a):
        for k, x in enumerate(row):
            if x is None:
                continue
            for j, y in enumerate(b[k]):
                if y is not None:
                    best, cost = out[i][j], x[0] + y[0]
                    if best is None or cost <= best[0]:
                        out[i][j] = better(best, (cost, joined(x[1], y[1])))
    return out


def _inserts() -> Matrix:
    """Cheapest inserts from state to state."""
    m: Matrix = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]
    for i, j, n in ((START, AFTER_U, 1), (START, AFTER_A, 2), (AFTER_S, AFTER_U, 1), (AFTER_S, AFTER_A, 2), (AFTER_U, AFTER_A, 1), (AFTER_A, AFTER_U, 1)):
        m[i][j] = (INSERT * n, "I" * n)
    return m


INSERTS = _inserts()
TO_USER, TO_ASSISTANT = (START, AFTER_S, AFTER_A), (AFTER_U,)


def row_matrix(symbol: str) -> Matrix:
    """Edits of one row, then inserts. ``symbol``: D must go; else the role class,
    upper case where truncated."""
    m: Matrix = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if symbol != "D":
        more, role = TRUNCATED * symbol.isupper(), symbol.lower()
        for sources, end, letter in ((TO_USER, AFTER_U, "u"), (TO_ASSISTANT, AFTER_A, "a")):
            for i in sources:
                m[i][end] = better(m[i][end], (REROLE + more, "R"))
                if role == letter:
                    m[i][end] = better(m[i][end], (KEEP + more, "K"))
        if role == "s":
            m[START][AFTER_S] = (KEEP + more, "K")
    return product(m, INSERTS)


class Grammar:
    """Re-Pair rules over symbols, with one matrix each."""

    def __init__(self) -> None:
        self.names: dict[object, int] = {}
        self.matrices: list[Matrix] = []

    def symbol(self, letter: str) -> int:
        if letter not in self.names:
            self.names[letter] = len(self.matrices)
            self.matrices.append(row_matrix(letter))
        return self.names[letter]

    def rule(self, pair: tuple[int, int]) -> int:
        if pair not in self.names:
            self.names[pair] = len(self.matrices)
            self.matrices.append(product(self.matrices[pair[0]], self.matrices[pair[1]]))
        return self.names[pair]

    def compress(self, words: list[list[int]]) -> None:
        """Replace pairs that occur twice at least by rules, the most frequent first, in place."""
        counts: Counter = Counter(p for w in words for p in pairwise(w))
        where: dict[tuple[int, int], set[int]] = defaultdict(set)
        for k, w in enumerate(words):
            for p in pairwise(w):
                where[p].add(k)
        heap = [(-n, p) for p, n in counts.items() if n > 1]
        heapq.heapify(heap)
        while heap:
            n, pair = heapq.heappop(heap)
            if counts[pair] != -n:
                if counts[pair] > 1:
                    heapq.heappush(heap, (-counts[pair], pair))
                continue
            new, touched = self.rule(pair), Counter()
            for k in sorted(where.pop(pair)):
                old, w, i = words[k], [], 0
                while i < len(old):
                    hit = i + 1 < len(old) and (old[i], old[i + 1]) == pair
                    w.append(new if hit else old[i])
                    i += 1 + hit
                counts.subtract(pairwise(old))
                for p in pairwise(w):
                    touched[p] += 1
                    where[p].add(k)
                counts.update(pairwise(w))
                words[k] = w
            counts[pair] = 0
            for p in touched:
                if counts[p] > 1:
                    heapq.heappush(heap, (-counts[p], p))

    def evaluate(self, blocks: list[str]) -> dict[str, Matrix]:
        """The matrix of each block, by the rules that all of them share."""
        if len(self.matrices) > MOST_RULES:
            self.__init__()
        words = [[self.symbol(c) for c in b] for b in blocks]
        self.compress(words)
        out = {}
        for b, w in zip(blocks, words):
            m = self.matrices[w[0]]
            for s in w[1:]:
                m = product(m, self.matrices[s])
            out[b] = m
        return out


class Fold:
    """The cheapest edits from the start of one conversation, block by block."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.entries = [x and (x[0], flat(x[1])) for x in INSERTS[START]]
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = ""

    def add(self, roles: str, faults: str, costs: list[int | None], audits: list[str | None]) -> None:
        self.blank += faults.count("b")
        self.duplicate += faults.count("d")
        self.truncated += faults.count("t")
        self.illegal += sum(a + b not in LEGAL for a, b in pairwise(self.last + roles))
        self.last = roles[-1]
        new: list[tuple[int, str] | None] = [None] * 4
        for i, x in enumerate(self.entries):
            for j in range(4):
                if x is not None and costs[4 * i + j] is not None:
                    y = (x[0] + costs[4 * i + j], x[1] + audits[4 * i + j])
                    new[j] = y if new[j] is None else min(new[j], y)
        tails = [x[1] for x in new if x]
        n = common(min(tails), max(tails))
        self.settled.append(tails[0][:n])
        self.entries = [x and (x[0], x[1][n:]) for x in new]

    def row(self, conv: object) -> tuple:
        cost, tail = min(x for x in (self.entries[START], self.entries[AFTER_A]) if x)
        return conv, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.settled) + tail


def common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def placed_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, part, row (the order of all rows) and fault
    (b, d, t or -) of every row; a table in the shared folder."""
    small_batches(turns.sparkSession)
    told = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), told("role"), told("text"))
    order = ["conv_id", "turn", "role"]
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    part, row = row_number_columns()
    rows = shared_table(ranged.select("*", part.alias("part"), row.alias("row")), "turns")
    own = [F.xxhash64(F.lit(i), F.col("conv_id").isNull(), "conv_id", "role", "text").alias(f"key{i}") for i in (1, 2)]
    blank = ~F.col("text").rlike(WORD)
    faults = F.when(blank, "b").when(~F.col("text").rlike(ENDED), "t").otherwise("-")
    narrow = shared_table(rows.select("part", "row", *own, faults.alias("fault")).where("fault <> 'b'"), "turn-keys")
    first = narrow.groupBy("key1", "key2").agg(F.min(F.struct("part", "row")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = narrow.join(first, ["key1", "key2"]).where(F.struct("part", "row") > F.col("first"))
    again = again.select("part", "row", F.lit(True).alias("again"))
    judged = rows.join(again, ["part", "row"], "left")
    return shared_table(judged.select(*rows.columns, F.when(blank, "b").when(F.col("again"), "d").otherwise(faults).alias("fault")), "judged-turns")


DIAGNOSES = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_MATRIX = "conv_id long, part int, block long, roles string, faults string, costs array<int>, audits array<string>"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grammar, known = Grammar(), {}
    for b in batches:
        symbols = b["symbols"].to_pylist()
        new = sorted(set(symbols) - known.keys())
        if len(known) + len(new) > MOST_RULES:
            known, new = {}, sorted(set(symbols))
        for s, m in grammar.evaluate(new).items():
            known[s] = [x and x[0] for r in m for x in r], [x and flat(x[1]) for r in m for x in r]
        costs, audits = zip(*(known[s] for s in symbols)) if symbols else ((), ())
        own = [pa.array(costs, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))]
        yield pa.record_batch([*(b[c] for c in ("conv_id", "part", "block", "roles", "faults")), *own], [c.split()[0] for c in _MATRIX.split(", ")])
    give_back()


def _streamed(new: Callable[[], object], add: Callable, columns: list[str], schema: pa.Schema) -> Callable:
    """One row for each conversation whose rows arrive together: ``add(state, row)``
    for each row, then ``state.row(conv_id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        frame = lambda rows: pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)
        for b in batches:
            rows = []
            for conv, *values in zip(b["conv_id"].to_pylist(), *(b[c].to_pylist() for c in columns)):
                if state is None or conv != last:
                    if state:
                        rows.append(state.row(last))
                    last, state = conv, new()
                add(state, *values)
            yield frame(rows)
        if state:
            yield frame([state.row(last)])

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def diagnoses(placed: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of every
    conversation of ``placed_rows``."""
    letter = F.substring("role", 1, 1)
    role = F.when(letter.isin("s", "u", "a"), letter).otherwise("o")
    symbol = F.when(F.col("fault").isin("b", "d"), "D").when(F.col("fault") == "t", F.upper(role)).otherwise(role)
    rows = placed.select("conv_id", "part", "row", F.floor(F.col("row") / BLOCK).alias("block"), role.alias("role"), "fault", symbol.alias("symbol"))
    listed = F.sort_array(F.collect_list(F.struct("row", "role", "fault", "symbol")))
    blocks = rows.groupBy("conv_id", "part", "block").agg(listed.alias("l"))
    text = lambda c: F.array_join(F.col(f"l.{c}"), "")
    words = blocks.select("conv_id", "part", "block", text("role").alias("roles"), text("fault").alias("faults"), text("symbol").alias("symbols"))
    made = shared_table(words.mapInArrow(_matrices, _MATRIX), "block-matrices")
    ordered = made.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    columns = ["roles", "faults", "costs", "audits"]
    return shared_table(ordered.mapInArrow(_streamed(Fold, Fold.add, columns, _schema(DIAGNOSES)), DIAGNOSES), "diagnoses")


REPAIRED = "conv_id long, position long, edit string, role string, text string"


class _Editor:
    """Applies an audit to the rows of one conversation, one at a time."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.position = audit, 0, "", 0

    def _written(self, edit: str, role: str, text: str) -> tuple:
        self.state, self.position = role[:1], self.position + 1
        return self.position - 1, edit, role, text

    def _wanted(self) -> str:
        return "assistant" if self.state == "u" else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._written("I", self._wanted(), "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._written(edit, role if edit == "K" else self._wanted(), text)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, editor, conv = _schema(REPAIRED), None, None
    for b in batches:
        rows = []
        for c, audit, role, text in zip(*(b[x].to_pylist() for x in ("conv_id", "audit", "role", "text"))):
            if audit is not None:  # the first row of a conversation
                rows += [(conv, *r) for r in editor.inserted()] if editor else []
                conv, editor = c, _Editor(audit)
            else:
                rows += [(conv, *r) for r in editor.row(role, text)]
        yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [()] * 5, schema)], schema=schema)
    if editor:
        rows = [(conv, *r) for r in editor.inserted()]
        if rows:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def repaired_turns(placed: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, position, edit, role, text of the rows of every repaired
    conversation, in order within each partition."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = found.select("conv_id", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("row"), "audit", none("string").alias("role"), none("string").alias("text"))
    rows = placed.select("conv_id", "part", "row", none("string").alias("audit"), "role", "text")
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part", "row").mapInArrow(_edited, REPAIRED)


class _Digest:
    def __init__(self) -> None:
        self.all, self.some = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.all.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
        self.some = True

    def row(self, conv: object) -> tuple:
        return conv, self.all.hexdigest()


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text``, joined by line breaks, of repaired
    conversations; relies on the order that ``repaired_turns`` leaves."""
    ddl = "conv_id long, repaired_sha256 string"
    return repaired.mapInArrow(_streamed(_Digest, _Digest.add, ["role", "text"], _schema(ddl)), ddl)


def turn_gaps(turns: DataFrame) -> DataFrame:
    """conv_id and gaps: turns that are missing between the first and the last."""
    distinct = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")).distinct()
    spread = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return distinct.groupBy("conv_id").agg(F.coalesce(spread, F.lit(0)).alias("gaps"))
