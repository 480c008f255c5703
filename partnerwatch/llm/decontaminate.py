"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are compared without case and punctuation. Every 3-gram of a test item is
a seed, however many documents hold it, so copies that leak push none out. A
document that holds a seed is aligned with the item around its seeds: word by
word, by Smith-Waterman with match 2, mismatch -1 and gap -1. The score is the
best alignment's over that of a full copy; a document is contaminated from
``THRESHOLD`` on, so copies with edits, gaps and paraphrased stretches count, as
long as three words in a row are left. Places where the words that item and
text have in common bound every alignment below the threshold are not aligned.

Documents are never shuffled: test items are the small side, sent to the tasks
in blocks of at most ``BLOCK_CHARS`` characters. With more items than that, the
documents are scanned once for each block, its findings are written to the shared
folder, and the block is given up before the next one is read, so neither the
driver nor a task ever holds more than one block, however large the benchmark.

Defined results: null and empty texts and items match nothing; an item of one
or two words is its own seed; documents that repeat a doc_id give the rows of
each distinct text; of equal alignments of an item the first found, by its place in
the text, counts; long texts are aligned around all their seeds; an empty
table on either side gives an empty result. Further columns are passed on by
``clean_documents`` and left out by ``contaminations``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, shared_table, small_batches
from partnerwatch.llm.grams import WordHashes, ngrams

SEED, THRESHOLD, BLOCK_CHARS = 3, 0.5, 8_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_PLAIN = re.compile(r"[\W_]+")
FOUND_ROWS = "doc_id long, item_id long, score double, first_word long, last_word long"
FOUND = "array<struct<item_id:long,score:double,first_word:long,last_word:long>>"


def plain_word(word: bytes) -> bytes:
    """The word without case and punctuation."""
    core = word.strip(b".,;:!?()[]|*$%&#'\"-_")
    if core.isalnum():  # ASCII only
        return core
    text = core.decode("utf-8", "surrogatepass").lower()
    return (text if text.isalnum() else _PLAIN.sub("", text)).encode("utf-8", "surrogatepass")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment and the position in ``text`` where it
    ends, one row of the Smith-Waterman matrix at a time: gaps along the row are
    a running maximum."""
    ramp = np.arange(len(text) + 1) * -GAP
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top - 1
    return best, end


def span(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(score, first, last) of the best local alignment in ``text``."""
    score, last = align(item, text)
    if not score:
        return 0, 0, -1
    back, first = align(item[::-1], text[: last + 1][::-1])
    return (score, last - first, last) if back == score else (score, 0, last)


def _among(words: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    return ascending[np.minimum(np.searchsorted(ascending, words), len(ascending) - 1)] == words


def most_score(shared: np.ndarray) -> int:
    """No local alignment scores more than the best stretch of the words of one
    side, of which only ``shared`` ones can match."""
    sums = np.cumsum(np.where(shared, MATCH, max(MISMATCH, GAP)))
    return int((sums - np.minimum(np.minimum.accumulate(sums), 0)).max(initial=0))


@dataclass(frozen=True)
class Seeds:
    """Items of one block, and where each seed stands in them."""

    item_ids: list[int]
    words: list[np.ndarray]
    grams: np.ndarray  # ascending
    starts: np.ndarray  # of each gram in (items, places)
    items: np.ndarray
    places: np.ndarray
    sizes: tuple[int, ...]

    @classmethod
    def of(cls, rows: list[tuple[int, np.ndarray]]) -> Seeds:
        grams, items, places = [], [], []
        for i, (_, words) in enumerate(rows):
            g = ngrams(words, min(SEED, len(words)))
            grams.append(g)
            items.append(np.full(len(g), i))
            places.append(np.arange(len(g)))
        g, i, p = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, items, places))
        order = np.argsort(g, kind="stable")
        unique, starts = np.unique(g[order], return_index=True)
        sizes = sorted({min(SEED, len(w)) for _, w in rows})
        return cls([r[0] for r in rows], [r[1] for r in rows], unique.astype(np.uint64), np.append(starts, len(g)), i[order], p[order], tuple(sizes))

    def marks(self) -> np.ndarray:
        """A bit for the lower end of each gram, to pass over most words fast."""
        marks = np.zeros(1 << 22, bool)
        marks[self.grams & np.uint64(len(marks) - 1)] = True
        return marks

    def hits(self, words: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the text, seed) of every seed that the text holds."""
        at, seeds = [], []
        for n in self.sizes:
            g = ngrams(words, n)
            near = np.flatnonzero(marks[g & np.uint64(len(marks) - 1)])
            k = np.searchsorted(self.grams, g[near])
            k[k == len(self.grams)] = 0
            sure = self.grams[k] == g[near] if len(near) else np.empty(0, bool)
            at.append(near[sure])
            seeds.append(k[sure])
        return np.concatenate(at), np.concatenate(seeds)

    def find(self, words: np.ndarray, marks: np.ndarray, threshold: float) -> list[dict]:
        at, seeds = self.hits(words, marks)
        counts = self.starts[seeds + 1] - self.starts[seeds]
        each = np.repeat(np.arange(len(at)), counts)
        entry = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts) + self.starts[seeds][each]
        items, start = self.items[entry], at[each] - self.places[entry]
        order = np.lexsort((start, items))
        items, start = items[order], start[order]
        held, found = np.sort(words), []
        for own in np.split(np.arange(len(items)), np.flatnonzero(np.diff(items)) + 1) if len(items) else ():
            i = items[own[0]]
            item = self.words[i]
            n, best = len(item), (0, 0, -1)
            least = threshold * MATCH * n
            if most_score(_among(item, held)) < least:
                continue
            begins, by_hash = np.unique(start[own]), np.sort(item)
            for run in np.split(begins, np.flatnonzero(np.diff(begins) > 2 * n) + 1):
                low = max(int(run[0]) - n, 0)
                text = words[low : int(run[-1]) + 2 * n]
                if most_score(_among(text, by_hash)) < least or most_score(_among(item, np.sort(text))) < least:
                    continue
                score, first, last = span(item, text)
                if score > best[0]:
                    best = (score, first + low, last + low)
            if best[0] >= least:
                found.append({"item_id": self.item_ids[i], "score": best[0] / (MATCH * n), "first_word": best[1], "last_word": best[2]})
        return found


def seed_blocks(benchmark: DataFrame) -> Iterator[tuple[Seeds, bool]]:
    """The items in blocks of at most about BLOCK_CHARS characters, one at a time,
    and whether it is the last one."""
    hashes = WordHashes(plain_word)
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), F.col("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-chars // BLOCK_CHARS)
    for b in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).orderBy("item_id", "text").toLocalIterator()
        rows = [(r["item_id"], w) for r in own if len(w := hashes.of(r["text"]))]
        if rows:
            yield Seeds.of(rows), b == n_blocks - 1


def _judge(sent: Broadcast, threshold: float):  # noqa: ANN202
    @F.pandas_udf(FOUND)
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, words = sent.value, WordHashes(plain_word)
        marks = own.marks()
        for batch in texts:
            yield pd.Series([own.find(words.of(t), marks, threshold) for t in batch], dtype=object)
        del words, marks
        give_back()

    return judge


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word of each leaked item."""
    small_batches(docs.sparkSession)
    found = docs.sparkSession.createDataFrame([], FOUND_ROWS)
    for seeds, last in seed_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(seeds)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(_judge(sent, threshold)(F.col("text"))).alias("f")).select("doc_id", "f.*")
        if not last:
            rows = shared_table(rows, "leaked-items")
            sent.destroy()
        found = found.unionByName(rows)
    return found.distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    small_batches(docs.sparkSession)
    for seeds, last in seed_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(seeds)
        docs = docs.where(F.size(_judge(sent, threshold)(F.col("text"))) == 0)
        if not last:
            docs = shared_table(docs, "clean-documents")
            sent.destroy()
    return docs
