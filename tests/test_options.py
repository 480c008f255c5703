"""Rejected lines, mergeable sketches, one-pass exploration."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from partnerwatch.functions import stats
from partnerwatch.operators import explore, silver
from partnerwatch.schemas import BRONZE_SCHEMA, BRONZE_TEXT_COLUMNS
from partnerwatch.sources import files
from tests.conftest import frame


def test_lines_go_to_two_sinks_and_add_up(spark, tmp_path):
    base = dict.fromkeys(BRONZE_TEXT_COLUMNS)
    lines = [("p", "1.5"), ("p", "n/a"), ("p", ""), (None, "3"), (None, "junk"), ("q", "-2"), ("q", "NaN"), ("q", "2e26"), ("q", None), ("q", "-Infinity")]
    rows = [tuple((base | {"BusinessPartner": p, "AmountInDisplayCurrency": a}).values()) for p, a in lines]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "judged")
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.option("header", True).csv(raw)
    bronze = files.read_placed_csv(spark, raw)
    files.write_judged(silver.judged_lines(bronze), out)
    kept = spark.read.parquet(out).filter("accepted = 'true'").select("BusinessPartner", "Amount")
    plain = silver.silver_projection(files.read_bronze_csv(spark, raw)).select("BusinessPartner", "Amount")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect())) == [("p", 1.5), ("q", 2.0)]
    found = {r["number"]: (r["causes"], json.loads(r["raw"])) for r in files.read_rejected(spark, out).collect()}
    amount, partner = "AmountInDisplayCurrency: ", "BusinessPartner: missing"
    want = {1: ["not a number"], 2: ["missing"], 3: [], 4: ["not a number"], 6: ["not finite"], 7: ["too large"], 8: ["missing"], 9: ["not finite"]}
    assert {n: c for n, (c, _) in found.items()} == {n: [amount + x for x in c] + ([partner] if n in (3, 4) else []) for n, c in want.items()}
    assert found[7][1]["AmountInDisplayCurrency"] == "2e26" and found[1][1]["BusinessPartner"] == "p"
    told = {r["cause"]: r["lines"] for r in files.reconciled(spark, out).collect()}
    assert told["kept"] == 2 and sum(told.values()) == len(lines) and told[amount + "missing"] == 2


def test_sketches_merge_and_keep_their_error(spark):
    rng = random.Random(2)
    values = [rng.lognormvariate(3, 2) for _ in range(6000)]
    df = frame(spark, {"day": [i % 9 for i in range(6000)], "g": ["ab"[i % 3 == 0] for i in range(6000)], "v": values})
    merged = stats.merge_sketches(stats.quantile_sketches(df, ["g", "day"], ["v"], 128), ["g"])
    probs = (0.0, 0.1, 0.5, 0.9, 0.999)
    for r in stats.sketched_quantiles(merged, ["g"], probs).collect():
        own = sorted(v for i, v in enumerate(values) if "ab"[i % 3 == 0] == r["g"])
        assert r["n"] == len(own)
        for i, p in enumerate(probs):
            rank = sum(v <= r[f"q{i}"] for v in own) / len(own)
            assert abs(rank - p) <= stats.rank_error(128) + 1 / len(own)
    small = df.filter("v < 3").withColumn("v", F.col("v") * 0 + 7.0)
    assert {r["q0"] for r in stats.sketched_quantiles(stats.quantile_sketches(small, [], ["v"]), [], (0.5,)).collect()} == {7.0}


def test_distinct_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 3).alias("g"), (F.col("id") % 7000).alias("c"), (F.col("id") % 50).alias("few"))
    told = stats.union_distinct(stats.distinct_sketches(df, ["g", "day"], ["c", "few"], 12), ["g"], ["c", "few"], 12).collect()
    exact = {r["g"]: r for r in df.groupBy("g").agg(F.count_distinct("c").alias("c"), F.count_distinct("few").alias("few")).collect()}
    for r in told:
        assert r["few__distinct"] == exact[r["g"]]["few"] and r["c__distinct"] == pytest.approx(exact[r["g"]]["c"], rel=0.05)


def test_exploration_in_one_pass_equals_the_tables(spark):
    rng = random.Random(1)
    rows = [(f"p{rng.randrange(9)}", rng.choice(["S", "T", None]), rng.choice(["AC", "ZC"]), rng.choice([None, 5.0, 20_000.0, 150_000.5]),
             rng.choice(["2024-01-03", "2024-02-01", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "BusinessPartner string, Segment string, CADocumentType string, Amount double, d string")
    df = df.withColumn("NetDueDate", F.col("d").cast("timestamp")).drop("d").cache()
    got = {(r["part"], r["key"]): r for r in explore.one_pass(df).collect()}
    for r in explore.segment_overview(df).collect():
        mine = got["segment", r["Segment"]]
        assert (mine["transactions"], mine["total_amount"], mine["partners"]) == (r["Transactions"], r["TotalAmount"], r["UniquePartners"])
    for r in explore.doc_type_counts(df).collect():
        assert got["doc_type", r["DocumentType"]]["rows"] == r["Count"]
    for r in explore.monthly_series(df).collect():
        assert (got["month", r["month"]]["transactions"], got["month", r["month"]]["total_amount"]) == (r["transaction_count"], r["total_amount"])
    whole, profile = got["all", None], explore.data_profile(df).collect()[0]
    assert (whole["rows"], whole["partners"], whole["first_date"], whole["last_date"]) == (profile["rows"], profile["partners"], profile["first_date"], profile["last_date"])
    assert (whole["largest"], whole["smallest"], whole["over_10k"], whole["over_100k"]) == (150_000.5, 5.0, df.filter("Amount > 10000").count(), df.filter("Amount > 100000").count())
    plan = explore.one_pass(df.select("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1
    assert explore.one_pass(df.limit(0)).collect() == []
