from __future__ import annotations

import zlib

import numpy as np

import __spark_entry__ as E
import corpus_pipeline as P
from partnerwatch.llm import decontaminate, jaccard_join, mixing, quality
from partnerwatch.llm.common import table
from partnerwatch.llm.token_files import encoder
from tests.llm.data import SF, docs
from tests.llm.test_jaccard import brute as brute_components


def test_queries_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_run_equals_the_stages_by_brute_force(spark):
    df, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r["doc_id"] for r in quality.score_documents(df, labels).collect() if r["predicted"]}
    first = df.where(df.doc_id.isin(sorted(good)))
    parts = brute_components([(r["doc_id"], r["text"]) for r in first.collect()])
    second = first.where(first.doc_id.isin([d for d, n, c in parts if d == c or not n]))
    leaked = {r["doc_id"] for r in decontaminate.contaminations(second, table(spark, SF, "benchmark")).collect()}
    third = second.where(~second.doc_id.isin(sorted(leaked))) if leaked else second
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(third).collect()}
    at, want = 0, []
    for r in sorted(third.collect(), key=lambda r: r["doc_id"]):
        ids = np.append(np.frombuffer(encoder(P.tokenizer_path(), False).encode(r["text"] or ""), "<u4"), 2).astype("<u4")
        for _ in range(copies[r["doc_id"]]):
            want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    assert 0 < len(good) < df.count() and len(parts) > second.count()
    assert [tuple(r) for r in P.run(spark, SF).orderBy("start").collect()] == want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    df = docs(spark, [(1, None), (None, "a b c"), (2, "")])
    for frame in (df, df.limit(0)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns and out.count() <= 3 * frame.count()
        assert P.STAGES[-1][1](spark, frame, SF).count() == frame.count()
    assert {s for s, _ in P.STAGES} == {"quality", "near_duplicates", "decontaminate", "mix", "tokens"}
    assert jaccard_join.PERCENT == 75
