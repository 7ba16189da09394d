"""Continuous ingestion of CSV(.gz) files: each content once, with counts per batch.

Two streams, one after the other. The first reads new files once, stages their rows and
writes a manifest of their contents. The second reads the manifest; a stateful operator
keeps the fingerprints of all contents seen, spread over the executors, so neither the
history nor the table is read again to find a repeated content. Counts are metrics
observed while the streams run, taken from their progress.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from parampipe.functions.hashing import FINGERPRINT, ROW_COUNT, fingerprint
from parampipe.operators.sinks import replace_slices
from parampipe.session import delete_path, discard, materialize
from parampipe.sources.files import read_or_empty, stream_csv
from parampipe.streaming.ingest import BATCH, SOURCE_FILE

FILES = "files"

# One row per batch and content; of files with one content the first by name.
MANIFEST = T.StructType(
    [
        T.StructField(FINGERPRINT, T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(ROW_COUNT, T.LongType()),
        T.StructField(FILES, T.LongType()),
        T.StructField(BATCH, T.LongType()),
    ]
)
COUNTS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField(FILES, T.LongType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("files_loaded", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField(BATCH, T.LongType()),
    ]
)
_READ, _SEEN, _NEW = "csv_read", "csv_seen", "csv_new"


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """Counts of every batch of all runs below `root`."""
    return read_or_empty(spark, f"{root}/counts", COUNTS)


def ingest_csv(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    root: str,
    run: str,
    files_per_batch: int = 1000,
    multi_line: bool = False,
) -> None:
    """Load all files of `source` not seen before into ``<root>/table``, then stop.

    A file is known by its path, a content by the fingerprint of its rows: a delivery
    under another name, or compressed anew, loads nothing. Every table below `root` is
    written by batch and overwrites itself when a batch is repeated after a failure.
    Files without rows load nothing and are not counted. Counts of a run that ended
    before it wrote them are added, by the next run, from what the batch left.
    """
    progress = _Progress()
    spark.streams.addListener(progress)
    try:
        read = stream_csv(spark, source, schema, files_per_batch, multi_line)
        read = read.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        read = read.observe(_READ, F.count(F.lit(1)).alias("rows_read"))
        progress.follow(_start(read, lambda rows, i: _stage(rows, i, root, schema), f"{root}/state_read"))
        if not read_or_empty(spark, f"{root}/manifest", MANIFEST).isEmpty():
            contents = _contents(spark, root)
            progress.follow(_start(contents, lambda new, i: _load(new, root, schema), f"{root}/state_load"))
    finally:
        spark.streams.removeListener(progress)
    _write_counts(spark, root, run, progress)
    # all batches staged so far are loaded
    delete_path(spark, f"{root}/staged")


def _contents(spark: SparkSession, root: str) -> DataFrame:
    """Contents of the manifest, one batch of it at a time, without those seen before."""
    seen = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1).parquet(f"{root}/manifest")
    seen = seen.observe(_SEEN, F.max(BATCH).alias(BATCH), F.sum(FILES).alias(FILES))
    new = seen.dropDuplicates([FINGERPRINT])
    return new.observe(_NEW, F.count(F.lit(1)).alias("files_loaded"), F.sum(ROW_COUNT).alias("rows_loaded"))


def _start(stream: DataFrame, work, state: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", state)
    return writer.trigger(availableNow=True).start()


def _stage(rows: DataFrame, batch_id: int, root: str, schema: T.StructType) -> None:
    """Write the rows of a batch once, and the manifest of their contents from the copy."""
    spark = rows.sparkSession
    number = F.lit(batch_id).cast("bigint").alias(BATCH)
    replace_slices(rows.withColumn(BATCH, number), f"{root}/staged", [BATCH], gather=False)
    staged = _staged(spark, root, schema).where(F.col(BATCH) == batch_id).drop(BATCH)
    first = F.min_by(F.struct(SOURCE_FILE, ROW_COUNT), SOURCE_FILE).alias("f")
    contents = fingerprint(staged, [SOURCE_FILE]).groupBy(FINGERPRINT).agg(first, F.count(F.lit(1)).alias(FILES))
    contents = contents.select(FINGERPRINT, "f.*", FILES, number)
    # at most one row per file of the batch, in one file: a batch of the second stream
    replace_slices(contents.coalesce(1), f"{root}/manifest", [BATCH], gather=False)


def _staged(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField(SOURCE_FILE, T.StringType()), T.StructField(BATCH, T.LongType())]
    return read_or_empty(spark, f"{root}/staged", T.StructType(fields))


def _load(new: DataFrame, root: str, schema: T.StructType) -> None:
    """Load the staged rows of the new contents, then write them into the history."""
    new = materialize(new, "stream-contents")
    # broadcast: no more rows than a batch has files
    wanted = F.broadcast(new.select(BATCH, SOURCE_FILE))
    rows = _staged(new.sparkSession, root, schema).join(wanted, [BATCH, SOURCE_FILE], "left_semi")
    replace_slices(rows.drop(SOURCE_FILE), f"{root}/table", [BATCH], gather=False)
    replace_slices(new, f"{root}/history", [BATCH], gather=False)
    discard(new)


def _write_counts(spark: SparkSession, root: str, run: str, progress: _Progress) -> None:
    observed = spark.createDataFrame(progress.counts(run), COUNTS)
    manifest = read_or_empty(spark, f"{root}/manifest", MANIFEST)
    history = read_or_empty(spark, f"{root}/history", MANIFEST)
    known = read_counts(spark, root).select(BATCH).union(observed.select(BATCH))
    loaded = history.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("files_loaded"), F.sum(ROW_COUNT).alias("rows_loaded")
    )
    # a content's files have its rows each
    left = manifest.join(known, BATCH, "left_anti").groupBy(BATCH).agg(
        F.sum(FILES).alias(FILES), F.sum(F.col(ROW_COUNT) * F.col(FILES)).alias("rows_read")
    )
    left = left.join(loaded, BATCH, "left").withColumn("run", F.lit(run)).na.fill(0)
    counts = materialize(observed.unionByName(left.select(*COUNTS.fieldNames())), "stream-counts")
    replace_slices(counts, f"{root}/counts", [BATCH], gather=False)
    discard(counts)


class _Progress(StreamingQueryListener):
    """Observed metrics of the batches of the streams it follows."""

    def __init__(self) -> None:
        self._metrics: dict[str, list[tuple[int, dict]]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def follow(self, query: StreamingQuery) -> None:
        """Wait for the end of a stream and of its events, which come a little later."""
        query.awaitTermination()
        with self._changed:
            self._changed.wait_for(lambda: str(query.id) in self._ended, timeout=60)

    def counts(self, run: str) -> list[tuple]:
        """Rows of COUNTS of the batches both streams worked on."""
        read: dict[int, int] = {}
        found: list[tuple] = []
        for batch_id, metrics in (m for of_query in self._metrics.values() for m in of_query):
            if _READ in metrics:
                read[batch_id] = metrics[_READ]["rows_read"]
        for _i, metrics in (m for of_query in self._metrics.values() for m in of_query):
            seen, new = metrics.get(_SEEN), metrics.get(_NEW)
            if seen and new and seen[BATCH] in read:
                number = seen[BATCH]
                found.append((run, seen[FILES], read[number], new["files_loaded"], new["rows_loaded"] or 0, number))
        return found

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        with self._changed:
            self._metrics.setdefault(str(progress.id), []).append((progress.batchId, metrics))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.id))
            self._changed.notify_all()
