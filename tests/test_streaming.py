"""Incremental bronze -> silver landing: each file exactly once across runs."""

from __future__ import annotations

import csv

from partnerwatch.schemas import BRONZE_TEXT_COLUMNS
from partnerwatch.streaming import stage_new_bronze


def write_bronze(path, partners):
    names = ["Further", *reversed(BRONZE_TEXT_COLUMNS)]
    with open(path, "w", newline="") as fh:
        w = csv.DictWriter(fh, fieldnames=names)
        w.writeheader()
        for p in partners:
            w.writerow(dict.fromkeys(names) | {"BusinessPartner": p, "AmountInDisplayCurrency": "1.5"})


def test_incremental_landing(spark, tmp_path):
    bronze, silver, ckpt = tmp_path / "bronze", tmp_path / "silver", tmp_path / "ckpt"
    bronze.mkdir()
    write_bronze(bronze / "day1.csv", ["a", "b"])
    stage_new_bronze(spark, str(bronze), str(silver), str(ckpt))
    assert spark.read.parquet(str(silver)).count() == 2
    write_bronze(bronze / "day2.csv", ["c"])
    stage_new_bronze(spark, str(bronze), str(silver), str(ckpt))
    stage_new_bronze(spark, str(bronze), str(silver), str(ckpt))  # nothing new: no duplicates
    rows = sorted(r.BusinessPartner for r in spark.read.parquet(str(silver)).collect())
    assert rows == ["a", "b", "c"]


def test_batch_and_incremental_landings_read_as_one_table(spark, tmp_path):
    from partnerwatch.schemas import SILVER_SCHEMA
    from partnerwatch.sources import files

    silver, bronze = str(tmp_path / "silver"), tmp_path / "bronze"
    bronze.mkdir()
    write_bronze(bronze / "day1.csv", ["a", "b"])
    files.write_silver(spark.createDataFrame([("z",) + (None,) * (len(SILVER_SCHEMA) - 1)], SILVER_SCHEMA), silver)
    stage_new_bronze(spark, str(bronze), silver, str(tmp_path / "ckpt"))
    table = files.read_silver(spark, silver)
    assert table.columns == SILVER_SCHEMA.fieldNames() and sorted(r[0] for r in table.select("BusinessPartner").collect()) == ["a", "b", "z"]
