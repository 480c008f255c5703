"""Sources and sinks: OData pages, bronze CSV, silver/gold Parquet, observed counts."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Observation
from pyspark.sql import types as T

from partnerwatch.operators import silver
from partnerwatch.plans import pipeline as P
from partnerwatch.schemas import BRONZE_TEXT_COLUMNS
from partnerwatch.sources import files, odata

REC = T.StructType([T.StructField("BusinessPartner", T.StringType()), T.StructField("Amount", T.StringType())])


def test_odata_pages_from_files(spark, tmp_path):
    pages = [
        {"d": {"results": [{"__metadata": {"uri": "x(1)"}, "BusinessPartner": "1", "Amount": "10.5"},
                           {"__metadata": {"uri": "x(2)"}, "BusinessPartner": "2", "Amount": "-3"}],
               "__next": "x?$skiptoken=2"}},
        {"d": {"results": [{"__metadata": {"uri": "x(3)"}, "BusinessPartner": "3", "Amount": "7"}]}},
    ]
    for i, p in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(p, indent=2))
    rows = odata.read_pages(spark, str(tmp_path), REC)
    assert rows.columns == ["BusinessPartner", "Amount"]
    assert sorted(r.BusinessPartner for r in rows.collect()) == ["1", "2", "3"]
    assert odata.read_pages(spark, str(tmp_path), REC, filter_expr="BusinessPartner <> '2'").count() == 2
    assert odata.read_pages(spark, str(tmp_path), REC, top=1).count() == 1


def test_odata_next_links(spark):
    df = spark.createDataFrame([('{"d": {"results": [], "__next": "n1"}}',), ('{"d": {"results": []}}',)], "body string")
    assert sorted(str(r.next_link) for r in odata.next_links(df, "body", REC).collect()) == ["None", "n1"]


def bronze_rows():
    base = dict.fromkeys(BRONZE_TEXT_COLUMNS)
    good = dict(base, BusinessPartner="7", AmountInDisplayCurrency="-12.50", NumberOfItems="3",
                CANetDueDate="/Date(1745884800000)/", BalanceAmountInDisplayCurrency="1e3")
    junk_amount = dict(base, BusinessPartner="8", AmountInDisplayCurrency="n/a", CANetDueDate="junk")
    no_partner = dict(base, AmountInDisplayCurrency="5")
    neg_date = dict(base, BusinessPartner="9", AmountInDisplayCurrency="1", CANetDueDate="/Date(-86400000+0100)/")
    return [good, junk_amount, no_partner, neg_date]


def test_bronze_csv_to_silver(spark, tmp_path):
    import csv

    path = tmp_path / "bronze.csv"
    with open(path, "w", newline="") as fh:
        w = csv.DictWriter(fh, fieldnames=list(BRONZE_TEXT_COLUMNS))
        w.writeheader()
        w.writerows(bronze_rows())
    obs = Observation("staging")
    out = silver.build_silver(files.read_bronze_csv(spark, str(path)), obs)
    rows = {r.BusinessPartner: r for r in out.collect()}
    assert set(rows) == {"7", "9"}
    assert rows["7"].Amount == 12.5 and rows["7"].Balance == 1000.0 and rows["7"].NumberOfItems == 3
    assert rows["7"].NetDueDate.isoformat().startswith("2025-04-29")
    assert rows["9"].NetDueDate.date() == date(1969, 12, 31)
    assert obs.get["raw_rows"] == 4


def test_silver_reject_count(spark):
    df = spark.createDataFrame(bronze_rows(), ", ".join(f"{c} string" for c in BRONZE_TEXT_COLUMNS))
    r = silver.silver_reject_count(df).collect()[0]
    assert (r.rejected_rows, r.raw_rows) == (2, 4)


def test_drop_columns_tolerant(spark):
    df = spark.createDataFrame([(1, 2)], "a int, __metadata int")
    assert silver.drop_columns(df, ["__metadata", "NotThere"]).columns == ["a"]


def test_pseudonymise(spark):
    df = spark.createDataFrame([("Acme",), ("  ",), (None,)], "BusinessPartnerName string")
    out = [r.BusinessPartnerName for r in silver.pseudonymise(df, redact_cols=()).collect()]
    assert out == ["CUSTOMER_" + __import__("hashlib").md5(b"Acme").hexdigest()[:6].upper(),
                   "CUSTOMER_UNKNOWN", "CUSTOMER_UNKNOWN"]


def test_silver_and_gold_round_trip(spark, tmp_path):
    s = P.fixture_silver(spark, "/root/testdata/sf0.001")
    files.write_silver(s, str(tmp_path / "silver"))
    back = files.read_silver(spark, str(tmp_path / "silver"))
    assert back.count() == s.count()
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in s.schema]
    gold = P.build_gold(back, date(2002, 1, 1), with_forest=False)
    files.write_gold(gold, str(tmp_path / "gold"))
    g = files.read_gold(spark, str(tmp_path / "gold"))
    assert g.count() == gold.count() and "Segment" in g.columns


def test_watchlist_csv(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.2), ("b", 0.9)], "BusinessPartner string, risk_score double")
    from partnerwatch.operators import alerts

    files.write_watchlist(alerts.watchlist(df), str(tmp_path / "wl"))
    back = spark.read.option("header", True).csv(str(tmp_path / "wl"))
    assert back.count() == 2
