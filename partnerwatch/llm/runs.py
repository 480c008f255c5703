"""Periodic run detection: recursive frequency splitting, then a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least max(``LEAST``, ``TIMES`` * q) words that no
neighbouring word extends keeping the period. Every word of a run occurs in it
``TIMES`` times at least. So a word that occurs fewer times within a segment
joins no run of it and splits it; the parts are split by their own counts in
turn, until no word of a segment is too rare there. All segments of a round are
counted together, by one sort of (segment, word).

What survives is scanned by lags: of a run of period q, ``TIMES`` multiples of q
at least lie inside it and hold equal words, so lag q looks at every q-th word
only, and at all words just around places where that many equal ones follow each
other. A place that a run of a smaller period covers as far is passed over: two
periods that meet on the sum of their lengths have a common one, which is found
already. A segment of m words takes about m log m steps whatever it holds.

A round that takes away less than a ``STALL``-th of the words it looked at ends
the splitting of these segments (texts can be made up in which each round frees
one word); they are scanned as they are, with the same result.

A document is the unit of work; rows are neither shuffled nor collected, and a
batch of bounded size is held at a time.

Defined results: a null or empty text, or one of white space, has no words, no
runs and an empty collapsed text; words are compared as they are written, case
included; of runs with equal exponents the one of the smallest start, then
period, is the strongest; repeated rows are judged each; a text of any length is
one text; an empty table gives an empty result. Further columns, also such named
like a result, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, small_batches

LEAST, TIMES = 6, 4
STALL = 256
RUN = "struct<start:long,length:long,period:long>"


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of ``text``."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words as equal numbers."""
    names: dict[bytes, int] = {}
    return np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))


def segments(x: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of the segments that frequency splitting leaves."""
    done: list[tuple[int, int]] = []
    starts, ends = (np.array([0]), np.array([len(x)])) if len(x) >= least else (np.empty(0, np.int64),) * 2
    base = int(x.max(initial=0)) + 1
    while len(starts):
        sizes = ends - starts
        segment = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[segment]
        _, word, counts = np.unique(segment * base + x[at], return_inverse=True, return_counts=True)
        stays = counts[word] >= times
        whole = np.bincount(segment, weights=~stays, minlength=len(starts)) == 0
        done += zip(starts[whole].tolist(), ends[whole].tolist())
        if whole.all():
            break
        if (~stays).sum() * STALL < sizes[~whole].sum():
            done += zip(starts[~whole].tolist(), ends[~whole].tolist())
            break
        open_ = stays & ~whole[segment]
        edge = np.diff(np.concatenate([[False], open_, [False]]).astype(np.int8))
        turn = np.flatnonzero(segment[1:] != segment[:-1]) + 1  # neighbours in the list of different segments
        cut = turn[open_[turn] & open_[turn - 1]] if len(turn) else turn
        first = np.sort(np.concatenate([np.flatnonzero(edge == 1), cut]))
        last = np.sort(np.concatenate([np.flatnonzero(edge == -1), cut])) - 1
        starts, ends = at[first], at[last] + 1
        large = ends - starts >= least
        starts, ends = starts[large], ends[large]
    return sorted(done)


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays of one size."""
    at, step = 0, 32
    while at < len(a):
        differ = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return len(a)


def lag_scan(x: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one segment."""
    m, found = len(x), []
    reach = np.zeros(m, np.int64)  # the farthest end of the runs that cover a place
    for q in range(1, m // times + 1):
        anchors = x[::q]
        equal = anchors[:-1] == anchors[1:]
        n = len(equal) - (times - 2)
        hit = equal[:n]
        for i in range(1, times - 1):
            hit = hit & equal[i : i + n]
        at = np.flatnonzero(hit) * q
        if not len(at):
            continue
        at = at[reach[at] <= at + (times - 1) * q]
        for near in (1, 2, 3, 5, 8, 13):
            if near < q and len(at):
                at = at[x[at + near] == x[at + near + q]]
        passed = -1
        for j in at.tolist():
            if j < passed:
                continue
            passed = j + _same(x[j : m - q], x[j + q :])
            start = j - _same(x[:j][::-1], x[q : j + q][::-1])
            length = passed + q - start
            if length >= max(least, times * q) and reach[start] < start + length:
                found.append((start, length, q))
                reach[start : start + length] = np.maximum(reach[start : start + length], start + length)
    return found


def runs_of(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    return sorted(((s + a, n, q) for a, b in segments(x) for s, n, q in lag_scan(x[a:b])), key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length over period; the first of equal ones."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return b" ".join(words).decode("utf-8", "surrogatepass")
    change = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        change[s + q] += 1
        change[s + n] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()]).decode("utf-8", "surrogatepass")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (by start, then period), strongest (null without runs) and
    collapsed: the text with each run held to its first period."""
    small_batches(docs.sparkSession)
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    named = lambda r: r and {"start": r[0], "length": r[1], "period": r[2]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_runs, texts = [], []
            for text in b["text"]:  # one text at a time
                words = words_of(text.as_py())
                runs = runs_of(numbered(words))
                all_runs.append(runs)
                texts.append(collapsed(words, runs))
            found = pa.array([[named(r) for r in runs] for runs in all_runs], pa.list_(kind))
            best = pa.array([named(strongest(runs)) for runs in all_runs], kind)
            yield pa.record_batch([b["doc_id"], found, best, pa.array(texts, pa.string())], ["doc_id", "runs", "strongest", "collapsed"])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, f"doc_id long, runs array<{RUN}>, strongest {RUN}, collapsed string")
