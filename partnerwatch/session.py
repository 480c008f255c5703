"""Session helpers for local runs and tests; library operators never create a
session. ``checkpoint_dir`` reads the cluster's ``spark.checkpoint.dir`` and
only falls back to a scratch directory for local runs where it is unset."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "partnerwatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint directory (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a scratch folder; a cluster
    session without one gets ``None`` (callers then refuse to run rather than
    write to a machine-local folder). Works without a SparkContext handle
    (Spark Connect) by reading the session configuration.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local"):
            conf_dir = tempfile.mkdtemp(prefix="pw-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        else:
            return None
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared checkpoint
    directory and return a scan of it.

    One job computes the frame once (``Dataset.checkpoint`` would compute it
    twice unless cached), the files live in the cluster's shared folder so
    they survive executor loss, and later reads get column pruning. A cluster
    session must name that folder.
    """
    path = _stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _stage_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/partnerwatch/{name}-{uuid.uuid4().hex}"


def cut_by_key(df: DataFrame, key: str, name: str = "stage") -> tuple[DataFrame, DataFrame]:
    """``cut_lineage`` into a table bucketed by ``key``: (by key, plain), two scans of
    the same files. In the first the rows of a key lie in one task, so groups and
    windows by it shuffle nothing; nor does the write, each task sorts its rows into
    the buckets. The second is split by size, for keys with very many rows. The
    table's name is dropped at once, its files stay."""
    spark = df.sparkSession
    path = _stage_path(spark, name)
    table = f"partnerwatch_{uuid.uuid4().hex}"
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = df.write.format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, key).saveAsTable(table)
    by_key = spark.table(table)
    plain = spark.read.schema(by_key.schema).parquet(path)  # an empty table has no file that tells its columns
    spark.sql(f"DROP TABLE {table}")
    return by_key, plain


def near_key(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with the rows of a key in one of ``buckets`` tasks, the one that reads
    the key from a table of ``write_near_key``."""
    return df.repartition(buckets, key)


def write_near_key(df: DataFrame, path: str, key: str, buckets: int) -> int:
    """Write ``df`` to ``path`` bucketed by ``key``: one file a bucket where ``df`` lies
    by ``near_key``. Returns the number of buckets; 0 for no rows, which lie in no
    bucket, so one plain file tells the columns."""
    spark = df.sparkSession
    table, place = f"partnerwatch_{uuid.uuid4().hex}", _qualified(spark, path)
    df.write.format("parquet").option("path", place).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")
    try:
        spark.read.parquet(place)
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        spark.createDataFrame([], df.schema).write.mode("append").parquet(place)
        return 0
    return buckets


def read_near_key(spark: SparkSession, parts: Sequence[tuple[str, int | None]], schema: T.StructType, key: str,
                  buckets: int) -> DataFrame:
    """The rows of several folders, given with what ``write_near_key`` returned (None for
    plain ones), where the rows of a key lie in one of ``buckets`` tasks: one scan of
    all, or, where a folder has another number of buckets, a shuffle of all."""
    paths = [_qualified(spark, path) for path, n in parts if n != 0]
    if not paths or any(n not in (0, buckets) for _, n in parts) or any(c in path for path in paths for c in "*?[]{},'\\"):
        return near_key(spark.read.schema(schema).parquet(*[path for path, _ in parts]), key, buckets)
    top = os.path.commonprefix([f"{p.rpartition('/')[0]}/" for p in paths]).rpartition("/")[0]
    inner = ",".join(p[len(top) + 1:] for p in paths)
    table = f"partnerwatch_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # a union of bucketed scans would do, but Spark 4.1 can lose how it lies; a location may name several folders
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{top}/{inner if len(paths) == 1 else f'{{{inner}}}'}'")
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def _qualified(spark: SparkSession, path: str) -> str:
    """A table's location; a relative one would lie below the warehouse."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf).makeQualified(place).toString()
