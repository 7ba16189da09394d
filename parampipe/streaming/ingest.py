"""Continuous ingestion of extract files, each file and each content once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions.hashing import FINGERPRINT, ROW_COUNT, fingerprint
from parampipe.operators.sinks import replace_slices
from parampipe.session import is_small, materialize
from parampipe.sources.files import read_or_empty

SOURCE_FILE = "source_file"
BATCH = "batch_id"
# File lists up to this many rows are sent to every executor.
BROADCAST_FILES = 100_000

STREAM_HISTORY = T.StructType(
    [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(ROW_COUNT, T.LongType()),
        T.StructField(FINGERPRINT, T.StringType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def ingest_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    history: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Load all files not seen before, then stop.

    The stream's checkpoint remembers files by path. Within a batch, files whose
    content is already in the history, and repeats inside the batch, are left
    out. Data and history are written under the batch number and overwrite
    themselves when a batch is repeated after a failure.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, table, history)

    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    )
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_batch(batch: DataFrame, batch_id: int, table: str, history: str) -> None:
    spark = batch.sparkSession
    earlier = read_or_empty(spark, history, STREAM_HISTORY).where(F.col(BATCH) != batch_id)
    files = fingerprint(batch, [SOURCE_FILE])
    first = files.groupBy(FINGERPRINT).agg(
        F.min_by(F.struct(SOURCE_FILE, ROW_COUNT), SOURCE_FILE).alias("f")
    )
    fresh = first.join(earlier.select(FINGERPRINT).distinct(), FINGERPRINT, "left_anti").select(
        f"f.{SOURCE_FILE}", f"f.{ROW_COUNT}", FINGERPRINT, F.lit(batch_id).cast("bigint").alias(BATCH)
    )
    fresh = materialize(fresh, "stream-files")
    wanted = fresh.select(SOURCE_FILE)
    if is_small(wanted, BROADCAST_FILES):
        wanted = F.broadcast(wanted)
    rows = batch.join(wanted, SOURCE_FILE, "left_semi").withColumn(
        BATCH, F.lit(batch_id).cast("bigint")
    )
    replace_slices(rows.drop(SOURCE_FILE), table, [BATCH], gather=False)
    replace_slices(fresh, history, [BATCH], gather=False)
