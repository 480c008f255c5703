"""One-scan rollup, one-to-one netting, replayable forest, OData filter and page chains."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from partnerwatch.operators import features, iforest, pairing, rollup
from partnerwatch.plans import pipeline as P
from partnerwatch.sources import fixtures as FX
from partnerwatch.sources import odata
from partnerwatch.sources.odata_filter import FilterError, filter_column

SCHEMA = ("CADocumentNumber string, BusinessPartner string, CADocumentType string, Amount double, Segment string, "
          "TransactionType string, BusinessPartnerName string, CAMainTransaction string, ContractAccount string, "
          "NumberOfItems int, Balance double, DaysOverdue int, ROSScore double, ACDocCount int, ZCDocCount int, IsRoundAny int")


def ledger(spark, n=900, seed=0, amount=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.choice(["AC", "ZC", "RV", "RV", None])
        value = amount(rng) if amount else rng.choice([round(rng.uniform(0, 60), 0) / 2, rng.uniform(0, 9), None, 12.345, 7e11 + rng.random()])
        rows.append((f"d{rng.randrange(10**6):07d}", f"p{rng.choice([0, 0, 0, 1, 2, 3, 4])}", kind, value, rng.choice(["A", "B", None]),
                     rng.choice(["x", "y"]), rng.choice(["n1", "n2", None]), rng.choice(["m1", "m2", None]), f"c{rng.randrange(40)}",
                     rng.randrange(9), rng.uniform(-5, 5), rng.choice([None, rng.randrange(-9, 99)]), rng.random(),
                     int(kind == "AC"), int(kind == "ZC"), rng.randrange(2)))
    return spark.createDataFrame(rows, SCHEMA).dropna(subset=["BusinessPartner"])


def test_one_scan_rollup_equals_the_joined_one(spark):
    df = ledger(spark)
    old = features.aggregate_to_partner_level(features.net_cancellation_pairs(df))
    new = rollup.netted_rollup(df)
    assert new.columns == old.columns
    want, got = ({r["BusinessPartner"]: r.asDict() for r in x.collect()} for x in (old, new))
    assert want.keys() == got.keys()
    for p in want:
        for c, v in want[p].items():
            assert got[p][c] == pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else got[p][c] == v, (p, c)
    flagged = features.netting_summary(features.net_cancellation_pairs(df)).collect()
    assert rollup.netting_totals(rollup.ledger_groups(df)).collect() == flagged


def test_equal_amounts_deviate_by_exactly_nothing(spark):
    for value in (0.1, 33.33, 12.345, 9876543.21):
        df = ledger(spark, 200, amount=lambda rng, v=value: v).withColumn("CADocumentType", F.lit("RV"))
        assert {r["StdAmount"] for r in rollup.netted_rollup(df).collect()} == {0.0}


def test_deviation_of_close_large_amounts(spark):
    df = ledger(spark, 400, amount=lambda rng: 5e7 + rng.randrange(3) / 100).withColumn("CADocumentType", F.lit("RV"))
    held = defaultdict(list)
    for r in df.collect():
        held[r["BusinessPartner"]].append(round((r["Amount"] - 5e7) * 100) / 100)
    got = {r["BusinessPartner"]: r["StdAmount"] for r in rollup.netted_rollup(df).collect()}
    for p, values in held.items():
        assert got[p] == pytest.approx(np.std(values, ddof=1), rel=1e-6)


def test_groups_scan_the_ledger_once(spark):
    df = rollup.ledger_groups(P.signals(FX.ledger_silver(spark, "/root/testdata/sf0.001"), date(2002, 1, 1)))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len([line for line in final.splitlines() if "FileScan" in line and "l_orderkey" in line]) == 1, final
    # by group and by (partner, netting key); the ledger's own joins are broadcast
    assert len([line for line in final.splitlines() if "Exchange hashpartitioning" in line]) == 2, final
    whole = P.partners(FX.ledger_silver(spark, "/root/testdata/sf0.001"), date(2002, 1, 1), folded=True)
    assert "l_orderkey" not in whole._jdf.queryExecution().executedPlan().toString()


def test_partners_whose_rows_all_cancel_are_dropped(spark):
    rows = [("1", "p", "AC", 5.0), ("2", "p", "ZC", 5.001), ("3", "q", "AC", 5.0), ("4", "q", "RV", 5.0)]
    df = spark.createDataFrame(rows, "CADocumentNumber string, BusinessPartner string, CADocumentType string, Amount double")
    got = rollup.netted_rollup(df).collect()
    assert [(r["BusinessPartner"], r["TotalTransactions"], r["NettedPairsCount"]) for r in got] == [("q", 2, 0)]
    assert rollup.netted_rollup(df.limit(0)).collect() == []


def test_credits_meet_reversals_one_to_one_also_in_a_hot_key(spark):
    rng, rows = random.Random(3), []
    for i in range(3000):
        hot = rng.random() < 0.6
        rows.append((f"{i:05d}", "hot" if hot else rng.choice("abc"), rng.choice(["AC", "AC", "ZC", "RV", None]),
                     50.0 if hot else rng.choice([1.0, 2.005, 2.0049, None, -3.0])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "CADocumentNumber string, BusinessPartner string, CADocumentType string, Amount double").repartition(6)
    want = {}
    held = defaultdict(lambda: {"AC": [], "ZC": []})
    keyed = df.select("*", F.bround("Amount", 2).alias("k")).collect()
    for r in keyed:
        if r["CADocumentType"] in ("AC", "ZC") and r["Amount"] is not None:
            held[r["BusinessPartner"], r["k"]][r["CADocumentType"]].append(r["CADocumentNumber"])
    for sides in held.values():
        n = min(map(len, sides.values()))
        for side in sides.values():
            want |= {d: i + 1 for i, d in enumerate(sorted(side)[:n])}
    out = pairing.net_one_to_one(df)
    got = out.collect()
    assert len(got) == len(rows) and out.columns == [*df.columns, "IsNetted", "NetPair"]
    assert {r["CADocumentNumber"]: r["NetPair"] for r in got if r["IsNetted"]} == want
    assert Counter(r["NetPair"] is None for r in got if not r["IsNetted"]) == {True: len(rows) - len(want)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = pairing.ranked_candidates(df, "BusinessPartner", "Amount", "CADocumentType", "CADocumentNumber", "AC", "ZC")
        assert cut.filter("BusinessPartner = 'hot'").count() > 1000
        order = [F.col("BusinessPartner"), F.col("Amount"), F.col("CADocumentType"), F.col("CADocumentNumber")]
        held_by = df.filter("CADocumentType in ('AC', 'ZC')").repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in held_by) < 1500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pairing.net_one_to_one(df.limit(0)).collect() == []


def test_forest_draws_are_uniform_and_replayable():
    text = "model|7|42"
    assert iforest.lanes(text, 3) == iforest.lanes(text, 3) and len(set(iforest.lanes(text, 3))) == 3
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, iforest.PRIME, (2, 4000))
    u = (a[:, None] * np.arange(1, 51) + b[:, None]) % iforest.PRIME / iforest.PRIME
    assert abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u[:, 3], u[:, 40])[0, 1]) < 0.06
    picks, cuts = [], []
    feature = np.array([iforest.lanes(f"feature|{i}|42", 1)[0] for i in range(19)])
    for tree in range(300):
        ta, tb = iforest.lanes(f"m|{tree}|42", 2)
        h = (ta * np.arange(1, 64) + tb) % iforest.PRIME
        sq = h * h % iforest.PRIME
        picks.append(((sq[:, None] * feature + h[:, None]) % iforest.PRIME).argmax(1))
        cuts.append((sq * iforest.lanes("cut|42", 1)[0] + h) % iforest.PRIME / iforest.PRIME)
    share = np.bincount(np.concatenate(picks), minlength=19) / (300 * 63)
    assert abs(share - 1 / 19).max() < 0.012
    cuts = np.concatenate(cuts)
    assert abs(np.histogram(cuts, 10, (0, 1))[0] / len(cuts) - 0.1).max() < 0.01


def test_depth_and_path_units():
    assert [iforest.max_depth(n) for n in (1, 2, 3, 4, 5, 256, 257)] == [1, 1, 2, 2, 3, 8, 9]
    assert iforest.path_units(2) == iforest.UNIT and iforest.path_units(1) == 0


def test_odata_filter_texts(spark):
    rows = [(1, "O'Neil", 5.0, "/Date(0)/", True), (2, None, None, None, None), (3, "abc", -2.5, "/Date(86400000)/", False)]
    df = spark.createDataFrame(rows, "Id long, Name string, Amount double, Due string, Open boolean")
    ids = lambda t: sorted(r["Id"] for r in df.filter(filter_column(t, df.columns)).collect())
    assert ids("Name eq 'O''Neil'") == [1] and ids("Name ne 'abc'") == [1, 2] and ids("not (Amount gt 0)") == [2, 3]
    assert ids("Amount ge -2.5M and Amount lt 5L or Id eq 2") == [2, 3]
    assert ids("Amount ge -2.5 and (Amount lt 6d or Id eq 2)") == [1, 3]
    assert ids("Due gt datetime'1970-01-01T12:00:00'") == [3] and ids("Name eq null") == [2] and ids("null ne Name") == [1, 3]
    assert ids("startswith(Name,'O') or endswith(Name, 'c')") == [1, 3] and ids("substringof('bc', tolower(Name))") == [3]
    assert ids("toupper(Name) eq 'ABC' and length(Name) eq 3") == [3] and ids("Open eq true") == [1] and ids("not Open eq true") == [2, 3]
    for bad in ("Name eq", "Nope eq 1", "Name eq 'x", "(Id eq 1", "Id eq 1 Id", "startswith(Name)", "Name", "'a' gt 1", "Id ; 1", ""):
        with pytest.raises(FilterError):
            filter_column(bad, df.columns)


def test_page_chains(spark):
    links = [("s", "a"), ("a", "b"), ("a", "b"), ("b", "gone"), ("x", "y"), ("y", None), ("c0", "c1"), ("c1", "c2"), ("c2", "c0"), (None, None)]
    links += [(f"l{i}", f"l{i + 1}" if i < 69 else None) for i in range(70)]
    frame = spark.createDataFrame([u for u in links if u[0]], "url string, next string")
    starts = spark.createDataFrame([("s",), ("c0",), ("l0",), ("l30",)], "url string")
    got = {(r["chain"], r["url"]): (r["position"], r["status"]) for r in odata.check_chains(frame, starts).collect()}
    want = {("s", "s"): (0, "ok"), ("s", "a"): (1, "doubled"), ("s", "b"): (2, "ok"), ("s", "gone"): (3, "missing"),
            (None, "x"): (None, "unreachable"), (None, "y"): (None, "unreachable")}
    want |= {("c0", f"c{i}"): (i, "ok") for i in range(3)}
    want |= {("l0", f"l{i}"): (i, "ok") for i in range(70)} | {("l30", f"l{i}"): (i - 30, "ok") for i in range(30, 70)}
    assert got == want
    texts = spark.createDataFrame([("u", '{"d": {"results": [{"a": 1}, {}], "__next": "v"}}'), ("w", "junk")], "u string, b string")
    assert sorted(map(tuple, odata.page_links(texts, "u", "b").collect())) == [("u", "v", 2), ("w", None, None)]
