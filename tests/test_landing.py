"""The CSV landing of raw lines, and landed ledger states."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from partnerwatch import config as C
from partnerwatch.operators import features
from partnerwatch.plans import incremental, registry
from partnerwatch.schemas import BRONZE_TEXT_COLUMNS
from partnerwatch.session import checkpoint_dir
from partnerwatch.sources import files, publish


def test_bronze_landing_is_compressed_and_cut_by_lines(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = spark.range(1000, numPartitions=1).select(
        *[F.concat(F.lit(f"{i}-"), F.lpad(F.col("id").cast("string"), 99, "0")).alias(c) for i, c in enumerate(C.BRONZE_DROP_COLUMNS)],
        F.concat(F.lit('say "a, b" '), F.col("id").cast("string")).alias("BusinessPartnerName"), F.lit(None).cast("string").alias("PostalCode"),
        F.col("id").cast("string").alias("BusinessPartner"))
    files.write_bronze_csv(rows, path, lines_a_file=300)
    parts = [f for f in (tmp_path / "bronze").iterdir() if f.name.startswith("part-")]
    assert len(parts) == 4 and sum(f.stat().st_size for f in parts) < 1000 * 1900 / 5
    back = files.read_bronze_csv(spark, path).select("BusinessPartner", "BusinessPartnerName", "PostalCode")
    assert sorted(map(tuple, back.collect())) == sorted((str(i), f'say "a, b" {i}', None) for i in range(1000))


@pytest.fixture
def damaged(spark, monkeypatch):
    """1,200 lines, 30 of each rest by 40; the first five rests are damaged by the landing."""
    lines = spark.range(1200, numPartitions=2).select(
        *[(F.concat(F.lpad(F.col("id").cast("string"), 19, "0"), F.lit("-" + "0" * 79)) if c == "CADocumentNumber" else
           F.lit("p, \"q\"") if c == "BusinessPartner" else F.lit("12.5") if c == "AmountInDisplayCurrency" else
           F.lit(None).cast("string")).alias(c) for c in BRONZE_TEXT_COLUMNS])
    monkeypatch.setattr(registry.FX, "ledger_bronze", lambda *_: lines)


def test_judged_lines_land_compressed(spark, damaged):
    path = Path(registry._judged_landing(spark, "").removeprefix("file:")).parent
    raw = [f for f in path.glob("bronze/part-*")]
    assert raw and all(f.name.endswith(".csv.gz") for f in raw) and sum(f.stat().st_size for f in raw) < 1200 * 115 / 5
    told = {r["cause"]: r["lines"] for r in registry.q_landing_reconciled(spark, "").collect()}
    assert len(told) == 6 and told.pop("kept") == 1050 and set(told.values()) == {30}


def test_rejected_lines_come_from_a_compressed_sink(spark, damaged):
    path = Path(registry._judged_landing(spark, "").removeprefix("file:"))
    kinds = {f.name.rpartition("-")[2] for f in path.glob("accepted=*/part-*")}
    assert kinds and all(k.endswith(".zstd.parquet") for k in kinds)
    told = registry.q_rejected_lines(spark, "").collect()
    assert sorted(int(r["CADocumentNumber"][:19]) for r in told) == [i for i in range(1200) if i % 40 < 5]
    assert {r["cause"] for r in told if int(r["CADocumentNumber"][:19]) % 40 == 3} == {
        "AmountInDisplayCurrency: missing; BusinessPartner: missing"}


LINES = ("BusinessPartner string, BusinessPartnerName string, ContractAccount string, CADocumentNumber string, CADocumentType string, "
         "CAMainTransaction string, CAAccountDeterminationCode string, Amount double, Balance double, TotalDebit double, "
         "TotalCredit double, NumberOfItems int, NetDueDate timestamp")


def ledger(spark, n=600):
    rows = []
    for i in range(n):
        kind, amount = ["AC", "ZC", "RV", None][i % 7 % 4], [5.0, 5.004, -0.0, None, 7.5, 20_000.0][i % 11 % 6]
        rows.append(("BUSY" if i % 4 == 0 else f"P{i % 23}", None if i % 5 == 0 else f"name {i % 3}", f"c{i % 6}" if i % 9 else None,
                     f"{i:05d}", kind, ["R000", "0060", None][i % 3], ["Z1", "Z9", None][i % 13 % 3], amount, float(i % 10), 2.0, 0.5,
                     i % 8, datetime(2001, 1, 1 + i % 28) if i % 6 else None))
    return spark.createDataFrame(rows, LINES)


def told(df):
    return sorted(str(sorted((k, round(v, 6) if isinstance(v, float) else v) for k, v in r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("most", [10_000, 60])
def test_landed_states_are_not_written_again(spark, tmp_path, monkeypatch, most):
    """One file a bucket of states; later landings merge them where they lie, without a
    further copy of lines or groups, whoever is busy and however many buckets others have."""
    lines, day, base = ledger(spark), date(2024, 5, 1), str(tmp_path / "tables")
    part = lambda i: lines.filter(F.crc32(F.col("CADocumentNumber").cast("binary")) % 3 == i).repartition(7)
    want = told(incremental.land(spark, str(tmp_path / "whole"), "all", lines, day))
    monkeypatch.setattr(features, "BUSY_ROWS", most)
    kept = Path(checkpoint_dir(spark).removeprefix("file:"), "partnerwatch")
    before = {p.name for p in kept.glob("*")}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        for name, rows, more in (("one", part(0), 0), ("two", part(1).filter("NumberOfItems > 3"), 0), ("none", part(2).limit(0), 0),
                                 ("three", part(2), 1), ("two", part(1), 1)):
            spark.conf.set("spark.sql.shuffle.partitions", str(buckets + more * (most == 60)))
            table = incremental.land(spark, base, name, rows, day)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    assert told(table) == want and told(incremental.full_partners(spark, base, day)) == want
    if most == 10_000:
        new = {p.name.rsplit("-", 1)[0] for p in kept.glob("*") if p.name not in before}
        assert new <= {"busy-partners", "changed-partners"}
        for path in publish.parts(spark, base, incremental.STATES).values():
            assert len(list(Path(path).glob("part-*"))) <= buckets
        held = list(publish.bucketed_parts(spark, base, incremental.STATES).values())
        assert sorted(n for _, n in held) == [0, buckets, buckets, buckets]
        plan = incremental._rolled(*incremental._landed(spark, held, buckets), day)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan
