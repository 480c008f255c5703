"""File sources and sinks (S2-S8): bronze CSV, silver/gold Parquet, alert
history, watchlist CSV. Paths are arguments; schemas are declared, never
inferred."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerwatch.schemas import BRONZE_SCHEMA, HISTORY_SCHEMA, SILVER_SCHEMA


def read_bronze_csv(spark: SparkSession, path: str, schema=BRONZE_SCHEMA) -> DataFrame:
    """Raw CSV with header, every column text. Columns are taken by their
    header names: other columns are left out, absent ones are NULL. All files
    of a path must have the header of the first; one that differs fails the
    read instead of shifting values."""
    raw = spark.read.options(header=True, inferSchema=False, enforceSchema=False, mode="PERMISSIVE").csv(path)
    have = set(raw.columns)
    return raw.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name in have
                        else F.lit(None).cast("string").alias(f.name) for f in schema.fields])


#: A compressed file is read by one task, so it holds this many lines at most.
LINES_A_FILE = 250_000


def write_bronze_csv(df: DataFrame, path: str, lines_a_file: int = LINES_A_FILE) -> None:
    """A landing of raw lines as CSV with header, compressed: wide lines repeat most of
    their text. Files are cut by lines, as a compressed file is not split."""
    df.write.options(header=True, compression="gzip", maxRecordsPerFile=lines_a_file).csv(path)


def read_placed_csv(spark: SparkSession, path: str, schema=BRONZE_SCHEMA) -> DataFrame:
    """``read_bronze_csv`` with where each line stands: ``_file``, ``_split`` (start of
    the split that read it) and ``_number`` (its number in that split, from 0)."""
    raw = spark.read.options(header=True, inferSchema=False, enforceSchema=False, mode="PERMISSIVE").csv(path)
    have = set(raw.columns)
    rows = raw.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name in have
                        else F.lit(None).cast("string").alias(f.name) for f in schema.fields],
                      F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                      F.monotonically_increasing_id().alias("_number"))
    return rows


def write_judged(df: DataFrame, path: str) -> None:
    """Kept and rejected lines (``operators.silver.judged_lines``) in one job: folders
    ``accepted=true`` and ``accepted=false`` of one table."""
    df.write.mode("overwrite").partitionBy("accepted").option("compression", "zstd").parquet(path)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """file, split, number, causes, raw of every rejected line."""
    rows = spark.read.parquet(path).filter(~F.col("accepted").cast("boolean"))
    return rows.select(F.col("_file").alias("file"), F.col("_split").alias("split"), F.col("_number").alias("number"), "causes", "raw")


def reconciled(spark: SparkSession, path: str) -> DataFrame:
    """(cause, lines): kept lines under ``kept``, each rejected line under all its
    causes joined; their sum is the number of bronze lines."""
    rows = spark.read.parquet(path).select("accepted", "causes")
    cause = F.when(F.col("accepted").cast("boolean"), "kept").otherwise(F.array_join("causes", "; "))
    return rows.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("lines"))


def write_silver(df: DataFrame, path: str) -> None:
    """S3: overwrite the silver Parquet table."""
    df.write.mode("overwrite").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The declared silver columns, whether the files lie in the folder itself (the
    batch job) or in one folder a batch (the incremental landing), or both."""
    return spark.read.schema(SILVER_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def write_gold(df: DataFrame, path: str, partition_col: str = "Segment") -> None:
    """Gold Parquet, partitioned by segment (a handful of values)."""
    writer = df.write.mode("overwrite")
    if partition_col in df.columns:
        writer = writer.partitionBy(partition_col)
    writer.parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_watchlist(df: DataFrame, path: str) -> None:
    """Ranked CSV with header. The frame is globally sorted (range
    partitioned), so part files concatenate in rank order; no single-task
    funnel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_watchlist(spark: SparkSession, path: str, schema) -> DataFrame:
    """The watchlist with ``rank``, from 1, in the order of its files and lines. A
    file is the unit of work, and each file's lines before it are a sum over files."""
    from pyspark.sql import Window

    rows = spark.read.options(header=True, enforceSchema=False).schema(schema).csv(path)
    name = F.col("_metadata.file_name")
    placed = rows.select(*rows.columns, name.alias("_file"), (F.col("_metadata.file_block_start")).alias("_at"),
                         F.monotonically_increasing_id().alias("_line"))
    held = placed.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_first"))
    before = Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1)  # one row a file block
    starts = held.select(F.col("_file").alias("_of"), F.col("_at").alias("_of_at"), "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    met = (F.col("_file") == F.col("_of")) & (F.col("_at") == F.col("_of_at"))
    rank = F.col("_before") + F.col("_line") - F.col("_first") + 1
    return placed.join(starts, met).select(*rows.columns, rank.alias("rank"))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The alert log with its declared schema; typed-empty when absent."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(path)
    except AnalysisException as exc:  # PATH_NOT_FOUND on the first run
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], HISTORY_SCHEMA)
        raise


def write_history(new_alerts: DataFrame, path: str, as_of: date) -> None:
    """today's alerts become the ``run_date = as_of`` partition.

    That partition's folder is replaced, also by an empty frame, so a rerun on
    the same day leaves exactly the alerts of the rerun; older partitions are
    never touched (the log is not read back and rewritten as a whole).
    """
    history_rows(new_alerts, as_of).drop("run_date").write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/run_date={as_of.isoformat()}")


def history_rows(new_alerts: DataFrame, as_of: date) -> DataFrame:
    """``new_alerts`` in the declared schema of the log, stamped with the day."""
    from partnerwatch.operators.alerts import stamp_for_history

    rows = stamp_for_history(new_alerts, as_of)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA.fields])
