"""Toxicity by maximum-scoring segment search over token log-odds.

Lexicon: each distinct word of a labelled document counts once, under its own
hash and those of its beginnings (stems that compounds share). The log-odds of
a bucket between toxic and clean documents take a Dirichlet prior in proportion
to the bucket's share of all documents; a bucket scores if its log-odds reach
``MIN_ODDS`` and ``MIN_Z`` standard deviations. All other words score a small negative drift.

Scan: the linear-time algorithm of Ruzzo and Tompa finds all maximal scoring
segments of a whole text. By extreme-value theory the chance of a segment of
score S in n clean words is 1 - exp(-K n e^(-lambda S)); lambda solves
sum p_s e^(lambda s) = 1 over the scores of clean words, K is fitted to the
segments of clean documents. Segments with an expected count below ``MAX_E``
are the significant passages. Their evidence, lambda S - ln(K n), summed over
the passages, gives the document's score by a logistic function fitted on
labelled documents, each scanned with a lexicon that has not seen it.

The model is fitted on a sample of labelled documents, by hash, of
``SAMPLE`` rows in expectation (all, if fewer). Held-out rows are never among
them. The lexicon has at most 2**20 buckets; what is broadcast is the part that
scores.

Defined results: null and empty texts have no passage and the score of none; a text
of any length is scanned whole; of passages that tie the scan keeps the one that
starts first;
without labels of both classes no word scores and the score is the share of
label 1 (0 without any). Repeated rows get equal scores, an empty table an
empty result. Further columns are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import shared_table, small_batches
from partnerwatch.llm.labels import held_out, logistic, training_labels

SAMPLE, PARTS, BUCKETS, MIN_Z, MIN_ODDS, MAX_E, DRIFT = 40_000, 4, 1 << 20, 3.0, 2.0, 0.05, -0.1
STEMS = (3, 4, 5, 6)
KEPT_WORDS = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")


def buckets(word: str) -> set[int]:
    """Buckets of a word: itself and its beginnings, told apart by a mark."""
    forms = [f"{word}$", *(word[:n] for n in STEMS if n <= len(word))]
    return {crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in forms}


class _Kept(dict):
    """A function of a word, kept for a bounded number of words."""

    def __init__(self, of) -> None:  # noqa: ANN001
        super().__init__()
        self.of = of

    def __missing__(self, word: str):  # noqa: ANN204
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = self.of(word)
        return value


def _token_buckets(token: str) -> tuple[int, ...]:
    return tuple(set().union(*(buckets(w) for w in _LETTERS.findall(token))))


def maximal_segments(tokens: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """(first token, last token, score) of every maximal scoring segment (Ruzzo
    and Tompa), given the tokens of positive score and their positions; the
    others score ``drift``. Linear in the number of positive tokens."""
    kept: list[list] = []  # [first, last, left sum, right sum, nearest earlier segment with a smaller left sum]
    total, at = 0.0, 0
    for position, score in tokens:
        left = total + drift * (position - at)
        total, at = left + score, position + 1
        new = [position, position, left, total, None]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = -1 if kept[j][4] is None else kept[j][4]
            if j < 0 or kept[j][3] >= new[3]:
                new[4] = j if j >= 0 else None
                kept.append(new)
                break
            new = [kept[j][0], new[1], kept[j][2], new[3], None]
            del kept[j:]
    return [(a, b, r - x) for a, b, x, r, _ in kept]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[int, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    k: float = 1.0
    intercept: float = -30.0
    slope: float = 0.0

    def token_score(self, token: str) -> float:
        """The largest log-odds among the token's buckets, 0 for none."""
        return max((self.weights.get(b, 0.0) for b in _token_buckets(token)), default=0.0)

    def scan(self, text: str, score_of: dict[str, float]) -> tuple[list[tuple[int, int, float]], int]:
        tokens = text.lower().split()
        positive = [(i, s) for i, s in enumerate(map(score_of.__getitem__, tokens)) if s]
        return maximal_segments(positive) if positive else [], len(tokens)

    def passages(self, text: str, score_of: dict[str, float]) -> list[tuple[int, int, float]]:
        """Significant passages: first word, last word, evidence."""
        segments, n = self.scan(text, score_of)
        found = [(a, b, self.rate * s - math.log(self.k * n)) for a, b, s in segments]
        return [x for x in found if x[2] >= -math.log(MAX_E)]

    def evidence(self, text: str, score_of: dict[str, float]) -> float:
        return math.log1p(sum(e for _, _, e in self.passages(text, score_of)))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.intercept + self.slope * evidence, -700), 700)))


def _weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-odds of buckets held by so many toxic and clean documents, 0 where
    they are too uncertain."""
    prior = 0.5 + (toxic + clean) / (n_toxic + n_clean)
    odds = np.log((toxic + prior) / (n_toxic + 1 - toxic + prior)) - np.log((clean + prior) / (n_clean + 1 - clean + prior))
    deviation = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return np.where((odds >= MIN_Z * deviation) & (odds >= MIN_ODDS), odds, 0.0)


def lexicons(rows: DataFrame, documents: np.ndarray) -> list[dict[int, float]]:
    """Scoring buckets from (text, label, part) rows: for each part those of all
    other parts, and last those of all. documents[part, label] counts the rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of = np.zeros((PARTS, 2, BUCKETS), np.int32), _Kept(_token_buckets)
        for b in batches:
            for text, label, part in zip(*(b[c].to_pylist() for c in ("text", "label", "part"))):
                own = set().union(*map(of.__getitem__, set((text or "").lower().split())))
                counts[part, label, np.fromiter(own, np.int64, len(own))] += 1
        for part in range(PARTS):
            some = np.flatnonzero(counts[part].any(0))
            columns = [np.full(len(some), part, np.int32), some, counts[part, 1, some], counts[part, 0, some]]
            yield pa.record_batch([pa.array(c) for c in columns], ["part", "bucket", "toxic", "clean"])

    counted = rows.mapInArrow(count, "part int, bucket long, toxic int, clean int")
    each = [F.sum(F.when(F.col("part") == p, F.col(c))).alias(f"{c}{p}") for p in range(PARTS) for c in ("clean", "toxic")]
    sums = counted.groupBy("bucket").agg(*each, F.sum("toxic").alias("toxic")).where("toxic > 1").toArrow().to_pandas()
    counts = sums.drop(columns=["bucket", "toxic"]).fillna(0).to_numpy(float).reshape(-1, PARTS, 2)
    whole, total = counts.sum(1), documents.sum(0)
    out = []
    for c, n in [(whole - counts[:, p], total - documents[p]) for p in range(PARTS)] + [(whole, total)]:
        w = _weights(c[:, 1], c[:, 0], n[1], n[0])
        out.append(dict(zip(sums["bucket"][w > 0].tolist(), w[w > 0].tolist())))
    return out


def _extreme_values(model: ToxicityModel, words: float, scores: dict[float, int], segments: float) -> ToxicityModel:
    """lambda and K from clean documents: the number of their words, how many words
    have each positive score, and how many segments reach the least positive one."""
    top = max(model.weights.values())
    scores = scores | {top: scores.get(top, 0) + 1}  # one word more than was seen, so that lambda exists
    s, n = (np.array(x, float) for x in zip(*sorted(scores.items())))
    p = n.sum() / max(words, n.sum() * 100.0)
    low, high = 0.0, 50.0 / s.max()
    for _ in range(100):
        mid = (low + high) / 2
        grown = (1 - p) * math.exp(mid * DRIFT) + p * (np.exp(mid * s) * n).sum() / n.sum()
        low, high = (mid, high) if grown < 1 else (low, mid)
    rate = max((low + high) / 2, 1e-3)
    least = min(model.weights.values())
    k = (segments + 0.5) / max(words, 1) * math.exp(rate * least)
    return ToxicityModel(model.weights, rate, k)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    known = training_labels(labels, "toxic").where("label in (0, 1)")
    total = known.count()
    share = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(total, 1)))
    # about `sample` narrow rows, whatever the size of the tables
    chosen = F.broadcast(known.where(share).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(PARTS)).cast("int")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("text", "label", "part")
    documents = np.zeros((PARTS, 2), np.int64)
    for r in chosen.groupBy("part", "label").count().collect():
        documents[r["part"], r["label"]] = r["count"]
    n_clean, n_toxic = documents.sum(0).tolist()
    if not n_toxic or not n_clean:
        return ToxicityModel(intercept=30.0 if n_toxic else -30.0)
    *others, weights = lexicons(rows, documents)
    if not weights or not all(others):
        return ToxicityModel(weights, intercept=math.log(n_toxic / n_clean), slope=2.0 if weights else 0.0)
    models = [ToxicityModel(w) for w in others]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [_Kept(m.token_score) for m in models]
        for b in batches:
            out = []
            for text, part in zip(b["text"].to_pylist(), b["part"].to_pylist()):
                found, n = models[part].scan(text or "", of[part])
                scores = [x for t in (text or "").lower().split() if (x := of[part][t])] if found else []
                out.append((n, [s for _, _, s in found], scores))
            n, segments, scores = zip(*out) if out else ((), (), ())
            kind = pa.list_(pa.float64())
            yield pa.record_batch([pa.array(n, pa.int64()), pa.array(segments, kind), pa.array(scores, kind), b["label"]], ["n", "segments", "scores", "label"])

    seen = shared_table(rows.mapInArrow(scan, "n long, segments array<double>, scores array<double>, label int"), "toxicity-scans")
    clean, least = seen.where("label = 0"), min(weights.values())
    reached = F.size(F.filter("segments", lambda x: x >= least))
    words, segments = clean.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(reached), F.lit(0))).first()
    # as many rows as the lexicon has scores, whatever the texts' lengths
    scores = clean.select(F.explode("scores").alias("score")).groupBy("score").count().toArrow().to_pylist()
    model = _extreme_values(ToxicityModel(weights), float(words), {r["score"]: r["count"] for r in scores}, float(segments))
    each = F.transform("segments", lambda x: x * F.lit(model.rate) - F.log(F.col("n") * F.lit(model.k)))
    found = F.aggregate(F.filter(each, lambda e: e >= F.lit(-math.log(MAX_E))), F.lit(0.0), lambda t, e: t + e)
    told = seen.select(F.log1p(found).alias("evidence"), "label").toArrow()  # two numbers for each sampled document
    intercept, slope = logistic(told["evidence"].to_numpy()[:, None], told["label"].to_numpy().astype(float))
    return ToxicityModel(model.weights, model.rate, model.k, float(intercept), float(slope))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and passages (first word, last word,
    evidence) of every document. Texts are scanned where they are read."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    @F.pandas_udf("score double, passages array<struct<first:long,last:long,evidence:double>>")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model.value
        of = _Kept(m.token_score)
        for batch in texts:
            found = [m.passages(t or "", of) for t in batch]
            scores = [m.score(math.log1p(sum(e for _, _, e in p))) for p in found]
            spans = [[{"first": a, "last": b, "evidence": e} for a, b, e in p] for p in found]
            yield pd.DataFrame({"score": scores, "passages": pd.Series(spans, dtype=object)})

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), judge("text").alias("j"))
    out = judged.select("doc_id", "held_out", F.col("j.score").alias("score"), F.col("j.passages").alias("passages"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
