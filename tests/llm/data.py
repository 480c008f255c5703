"""Small frames for the edge cases that every operator handles."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra: str = ""):
    """(doc_id, text[, source, *extra values]) rows as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *r[3:]) for r in rows]
    return spark.createDataFrame(full, DOCS + extra)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
