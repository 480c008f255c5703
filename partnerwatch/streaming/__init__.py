"""Incremental landing for the daily chain.

The daily job re-stages only the bronze files that arrived since the last run:
a file stream over the bronze folder with ``trigger(availableNow=True)``
processes every new file once and stops, and ``foreachBatch`` writes each
micro-batch to silver through the same ``build_silver`` projection as the
batch job, in a folder named by the batch. Progress (which files were consumed) lives in the stream's
checkpoint under the shared checkpoint folder, so a restarted or retried run
neither skips nor duplicates files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerwatch.operators import silver
from partnerwatch.schemas import BRONZE_TEXT_COLUMNS
from partnerwatch.session import checkpoint_dir


def _stream_checkpoint(spark: SparkSession, name: str, explicit: str | None) -> str:
    if explicit:
        return explicit
    base = checkpoint_dir(spark)
    if not base:
        raise ValueError("no checkpoint location: set spark.checkpoint.dir or pass checkpoint_location")
    return f"{base.rstrip('/')}/partnerwatch/streams/{name}"


def bronze_stream(spark: SparkSession, bronze_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of bronze CSV files, every column text, taken by header
    name: the header of the files at hand is the schema, and a file with another
    header fails the batch instead of shifting values."""
    header = spark.read.options(header=True, inferSchema=False).csv(bronze_dir).schema
    reader = spark.readStream.schema(header).options(header=True, enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(bronze_dir)
    return raw.select(*[F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string").alias(c)
                        for c in BRONZE_TEXT_COLUMNS])


def stage_new_bronze(spark: SparkSession, bronze_dir: str, silver_dir: str,
                     checkpoint_location: str | None = None, drop_columns=()) -> None:
    """Land every not-yet-seen bronze file in silver, then stop (blocking). Each
    batch overwrites a folder of its own id, so a batch that is replayed after a
    crash replaces what it had written."""
    def land(batch: DataFrame, batch_id: int) -> None:
        out = silver.build_silver(silver.drop_columns(batch, drop_columns))
        out.write.mode("overwrite").parquet(f"{silver_dir.rstrip('/')}/batch_id={batch_id}")

    query = (bronze_stream(spark, bronze_dir)
             .writeStream.foreachBatch(land)
             .option("checkpointLocation", _stream_checkpoint(spark, "bronze-to-silver", checkpoint_location))
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
