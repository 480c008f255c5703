from __future__ import annotations

import zlib

import numpy as np

from partnerwatch.llm import quality as Q
from partnerwatch.llm.common import table
from partnerwatch.llm.labels import training_labels
from tests.llm.data import docs, rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    got = Q.score_documents(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_moments_give_the_densities_of_a_direct_fit():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(200, 3)) @ np.diag([1, 2, 3]), rng.normal(size=(300, 3)) + 1]
    counts, sums, products = np.array([200.0, 300.0]), np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x])
    model = Q.fit(counts, sums, products, pooled=0.0, ridge=0.0)
    at = rng.normal(size=(50, 3))

    def density(a, share):
        m, c = a.mean(0), np.cov(a.T, bias=True)
        d = at - m
        return np.log(share) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d @ np.linalg.inv(c) * d).sum(1)

    want = 1 / (1 + np.exp(density(x[0], 0.4) - density(x[1], 0.6)))
    assert np.allclose(model.scores(at), want, atol=1e-9)


def test_statistics_of_any_text_are_finite():
    for text in ("", " \n\t", "a", "\U0001f642" * 3, "x" * 1_000_000, "\n" * 1000, "Ab1!# é\n" * 2000):
        s = Q.statistics(text)
        assert len(s) == len(Q.STATISTICS) and np.isfinite(s).all()


def test_edges(spark):
    df = docs(spark, [(1, None, "s", "k"), (2, "", "s", "k"), (None, "good text here", "s", "k"), (3, "w " * 50_000, "s", "k"), (3, "w", "s", "k"), (3, "w", "s", "k")], ", score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in Q.score_documents(df, none).collect()} == {0.5}
    assert {r["score"] for r in Q.score_documents(df, one).collect()} == {1.0}
    assert rows(Q.score_documents(df.limit(0), one)) == []
    kept = Q.keep_good(df, one)
    assert kept.columns == df.columns and kept.count() == 6
    assert rows(Q.keep_good(df.limit(0), none)) == []
    both = spark.createDataFrame([(i, y, 0) for i in (1, 3, 4, 5, 7) for y in (0, 1)], "doc_id long, quality int, toxic int")
    assert {r["label"] for r in training_labels(both, "quality").collect()} == {1}


def test_kept_rows_are_those_scored_good(spark):
    df, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r["doc_id"] for r in Q.score_documents(df, labels).collect() if r["predicted"]}
    assert {r["doc_id"] for r in Q.keep_good(df, labels).select("doc_id").collect()} == good
