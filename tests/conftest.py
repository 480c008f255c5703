from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = tmp_path_factory.mktemp("checkpoints")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("partnerwatch-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests own their scratch checkpoint folder; a cluster session keeps its own
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(ckpt))
    yield session
    session.stop()


def frame(spark, data: dict, schema: str | None = None):
    """DataFrame from a dict of equal-length columns."""
    cols = list(data)
    rows = list(zip(*[data[c] for c in cols]))
    if schema is not None:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame(rows, cols)


def by_key(df, key: str, col: str) -> dict:
    return {r[key]: r[col] for r in df.select(key, col).collect()}
