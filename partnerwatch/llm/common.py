"""Helpers shared by the operators: tables, shared storage, global positions."""

from __future__ import annotations

import ctypes
import uuid
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partnerwatch.session import checkpoint_dir

#: White space of the word definition: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of a row group of tables between steps: what a task's writer holds on the heap.
ROW_GROUP = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in ``spark.checkpoint.dir``."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it, so that a
    lost executor never costs more than the stage it worked on."""
    path = shared_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Hold Arrow batches at ``most`` bytes where the session allows more, so
    that a batch of very long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if not (now and now.isdigit() and 0 < int(now) <= most):
        spark.conf.set(key, str(most))


def give_back() -> None:
    """Return what a Python worker has freed to the system, as workers are kept
    for later tasks and memory of an executor is shared with its JVM."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def free_prefix(df: DataFrame) -> str:
    """A beginning for the names of helper columns that no column of ``df`` has."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def row_number_columns() -> tuple[Column, Column]:
    """(partition, row in the partition) of each row where it is computed."""
    i = F.monotonically_increasing_id()
    return F.shiftright(i, 33).cast("int"), i.bitwiseAND(F.lit((1 << 33) - 1))


def with_before(df: DataFrame, part: str, amount: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over all partitions before a
    row's own. The sums are a table of one row a partition, added up by a window
    and broadcast: bounded by the number of partitions, whatever they hold."""
    p = free_prefix(df)
    sums = df.groupBy(F.col(part).alias(f"{p}of")).agg(F.sum(amount).alias(f"{p}sum"))
    before = Window.orderBy(f"{p}of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(f"{p}of", F.coalesce(F.sum(f"{p}sum").over(before), F.lit(0)).cast("long").alias(name))
    return df.join(F.broadcast(starts), F.col(part) == F.col(f"{p}of")).drop(f"{p}of")


def global_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: each row's position, from 0, in ``order``. A range
    sort numbers the rows of each partition; no task sees them all."""
    part, row = row_number_columns()
    numbered = shared_table(df.orderBy(*order).select("*", part.alias("__part"), row.alias("__row")), name)
    placed = with_before(numbered, "__part", F.lit(1), "__before")
    return placed.withColumn(name, F.col("__before") + F.col("__row")).drop("__part", "__row", "__before")
