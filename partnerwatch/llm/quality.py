"""Quality classifier: regularised quadratic discriminant over text statistics.

Each whole text gives a vector of statistics (sizes, shares of character
classes, repetition of words and lines), transformed by logarithms. For each
class, Spark adds up counts, sums and products over all labelled documents that
are not held out, so the fit sees every one of them and the driver only gets
d x d numbers a class. A class covariance is shrunk towards the pooled one and
towards a multiple of the identity. Its Cholesky factor is computed once and
sent to the tasks; a document's score is the logistic function of the
difference of the two log densities (Mahalanobis distances by the inverted
factor) plus the log odds of the classes.

Defined results: a null text is an empty text, whose statistics are those of no
words; without labels of both classes the score is the share of label 1 (one
half without any). Repeated rows get equal scores, an empty table an empty
result. Further columns are passed on by ``keep_good`` and left out elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, shared_table, small_batches
from partnerwatch.llm.labels import held_out, training_labels

STATISTICS = (
    "word_length", "word_spread", "upper", "lower_start", "digits", "marks", "symbols",
    "non_ascii", "line_length", "distinct_words", "repeated_neighbours", "repeated_lines", "short_words",
)
UPPER, LOWER, DIGIT, SPACE, MARK, SYMBOL, OTHER = range(7)
FLOOR = 0.03  # added to a share before its logarithm


def _classes() -> np.ndarray:
    table = np.full(0x10000, OTHER, np.uint8)
    for i in range(0x10000):
        c = chr(i)
        kind = (c.isupper(), c.islower(), c.isdigit(), c.isspace(), c in ".,;:!?'\"()-", i < 128)
        table[i] = kind.index(True) if True in kind else OTHER
    return table


_TABLE: list[np.ndarray] = []


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS."""
    if not _TABLE:
        _TABLE.append(_classes())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_TABLE[0][np.minimum(points, 0xFFFF)], minlength=7)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, chars = len(words), max(len(text), 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    letters = max(int(kinds[UPPER] + kinds[LOWER] + kinds[OTHER]), 1)
    repeated = sum(map(eq, words, words[1:]))
    starts = sum(map(str.islower, (x.lstrip()[0] for x in lines)))
    rate = lambda part, whole: float(np.log(part / max(whole, 1) + FLOOR))
    return [
        float(np.log1p(lengths.mean() if n else 0)),
        float(np.log1p(lengths.std() if n else 0)),
        rate(kinds[UPPER], letters),
        rate(starts, len(lines)),
        rate(kinds[DIGIT], chars),
        rate(kinds[MARK], chars),
        rate(kinds[SYMBOL], chars),
        rate((points > 127).sum(), chars),
        float(np.log1p(min(chars / max(len(lines), 1), 100))),
        rate(len(set(words)), n),
        rate(repeated, n),
        rate(len(lines) - len(set(lines)), len(lines)),
        rate((lengths <= 3).sum(), n),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its vector ``x``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for b in batches:
            xs = [statistics(t or "") for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], pa.array(xs, kind)], ["doc_id", "x"])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class means, Cholesky factors and constants; ``share`` is the score
    where no densities could be fitted."""

    centre: np.ndarray | None
    scale: np.ndarray | None
    means: tuple[np.ndarray, ...]
    inverse: tuple[np.ndarray, ...]
    constants: tuple[float, ...]
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.centre is None:
            return np.full(len(x), self.share)
        z = np.clip((x - self.centre) / self.scale, -12, 12)
        density = [c - 0.5 * (((z - m) @ inv.T) ** 2).sum(1) for m, inv, c in zip(self.means, self.inverse, self.constants)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float, ridge: float) -> Discriminant:
    """Discriminant from counts[c], sums[c, d] and products[c, d, d] of the
    classes 0 and 1."""
    total = counts.sum()
    if counts.min() < 2:
        return Discriminant(None, None, (), (), (), float(counts[1] / total) if total else 0.5)
    centre = sums.sum(0) / total
    spread = products.sum(0) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
    means = [(s / n - centre) / scale for n, s in zip(counts, sums)]
    within = [(p / n - np.outer(s / n, s / n)) / np.outer(scale, scale) for n, s, p in zip(counts, sums, products)]
    common = (counts[:, None, None] * np.array(within)).sum(0) / total
    inverse, constants = [], []
    for n, s in zip(counts, within):
        c = (1 - pooled) * s + pooled * common
        c = (1 - ridge) * c + ridge * max(np.trace(c) / len(c), 1e-6) * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        inverse.append(np.linalg.inv(factor))
        constants.append(float(np.log(n / total) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(inverse), tuple(constants), float(counts[1] / total))


def train(stats: DataFrame, labels: DataFrame, pooled: float = 0.1, ridge: float = 0.02) -> Discriminant:
    """Fit on all labelled documents of ``stats`` that are not held out."""
    d = len(STATISTICS)
    known = stats.join(training_labels(labels, "quality"), "doc_id")

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for f in frames:
            for c in (0, 1):
                x = np.array(f["x"][f["label"] == c].tolist()).reshape(-1, d)
                counts[c] += len(x)
                sums[c] += x.sum(0)
                products[c] += x.T @ x
        flat = np.concatenate([np.concatenate([[counts[c]], sums[c], products[c].ravel()]) for c in (0, 1)])
        yield pd.DataFrame({"i": np.arange(len(flat)), "v": flat})

    rows = known.mapInPandas(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    flat = np.zeros(2 * (1 + d + d * d))
    flat[rows["i"]] = rows["v"]
    flat = flat.reshape(2, -1)
    return fit(flat[:, 0], flat[:, 1 : 1 + d], flat[:, 1 + d :].reshape(2, d, d), pooled, ridge)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. The texts are read
    once; their statistics are a narrow table in the shared folder."""
    stats = shared_table(document_statistics(docs), "quality-statistics")
    model = train(stats, labels)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist()).reshape(-1, len(STATISTICS))))

    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts. Texts are read twice and
    not shuffled. The statistics are written before the fit, so no task ever
    runs two Python nodes (and two workers) at once."""
    model = train(shared_table(document_statistics(docs), "quality-statistics"), labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([statistics(t or "") for t in text]).reshape(-1, len(STATISTICS))))

    return docs.where(score("text") >= threshold)
