"""Session settings and the shared scratch area used between stages."""

from __future__ import annotations

import atexit
import contextlib
import gc
import io
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Every writer and reader in this package also works without these; they are
# the settings a job on a large cluster wants.
ENGINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # size of one rebalanced output file / one post-shuffle partition
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "parampipe", master: str | None = None, **overrides: str
) -> SparkSession:
    """Session with `ENGINE_CONF`; `overrides` use `__` for the dots in a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can see.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of this machine.
    """
    global _local_root
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="parampipe-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared scratch area (created on first write)."""
    return os.path.join(scratch_root(spark), "parampipe", f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write `df` once to the shared scratch area and read it back.

    Used where a plan must be evaluated exactly once (positions, partition
    ids) or where its lineage should end. The copy survives lost executors.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    df.write.option("compression", compression).parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy.scratch_path = path
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete what `materialize` wrote; for copies that nothing will read again."""
    for copy in copies:
        delete_path(copy.sparkSession, copy.scratch_path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the cleaner remove the shuffle files of finished jobs.

    It does so when their plans are collected as garbage, which a driver with memory
    to spare puts off; a long chain of written tables would keep all of them.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through Spark's file systems; nothing if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The plan `df.explain(mode)` prints."""
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode=mode)
    return buffer.getvalue()


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when `df` has at most `max_rows` rows; reads no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows
