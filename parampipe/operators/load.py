"""Incremental loads: every part at most once, safe to repeat."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions.hashing import FINGERPRINT, ROW_COUNT, fingerprint
from parampipe.operators.sinks import folder_value, replace_slices
from parampipe.session import is_small, materialize
from parampipe.sources.files import read_or_empty

# Fixed value: name of the load history.
HISTORY_NAME = "_LOAD_HISTORY"

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("file_suffix", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("csv_file", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

# Part names up to this many are put into the scan as literal partition filters.
PRUNED_PARTS = 10_000

# Template lists up to this many rows are sent to every executor.
BROADCAST_TEMPLATES = 100_000

BY_SUFFIX, BY_HASH, BY_FILES = "suffix", "hash", "files"

# Partition column of a table loaded by hash: job and content, so that neither another
# part of the same name nor another job replaces a slice.
LOAD_KEY = "load_key"


@dataclass(frozen=True)
class Target:
    """Where a job's tables and its load history live."""

    spark: SparkSession
    root: str
    schema: str
    job: str = "-"

    def table_path(self, table: str) -> str:
        return f"{self.root}/{self.schema}/{table}"

    @property
    def history_path(self) -> str:
        return f"{self.root}/{HISTORY_NAME}"

    def history(self) -> DataFrame:
        return read_or_empty(self.spark, self.history_path, HISTORY_SCHEMA)

    def table(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of a table in the columns of `schema`."""
        rows = read_or_empty(self.spark, self.table_path(table), schema)
        return rows.select(*schema.fieldNames())


def manifest(source: DataFrame, part: str, identity: str = BY_SUFFIX) -> DataFrame:
    """One row per part of `source`: name, row count and, for ``hash``, fingerprint.

    Counting by name reads only the partition column; fingerprints read all
    columns but shuffle one record per task and part.
    """
    if identity == BY_HASH:
        parts = fingerprint(source, [part])
    else:
        parts = source.groupBy(part).agg(F.count(F.lit(1)).alias(ROW_COUNT))
        parts = parts.withColumn(FINGERPRINT, F.lit(None).cast("string"))
    return parts.select(
        F.col(part).alias("file_suffix"),
        F.col(FINGERPRINT).alias("file_hash"),
        F.col(ROW_COUNT),
    )


def pending_parts(
    parts: DataFrame, history: DataFrame, target: Target, table: str, identity: str
) -> DataFrame:
    """Parts of the manifest the history does not hold yet.

    By hash, parts with equal content count as one: the first name loads. By files,
    a part whose files are not those of its last load is open whatever its name.
    """
    if identity == BY_FILES:
        return parts
    if identity == BY_HASH:
        parts = parts.groupBy("file_hash").agg(
            F.min_by(F.struct("file_suffix", ROW_COUNT), "file_suffix").alias("p")
        ).select("p.file_suffix", "file_hash", f"p.{ROW_COUNT}")
        key, scope = "file_hash", F.col("job_name") == target.job
    else:
        key, scope = "file_suffix", F.col("schema_name") == target.schema
    done = history.where(scope & (F.col("table_name") == table)).select(key).distinct()
    return parts.join(done, parts[key].eqNullSafe(done[key]), "left_anti")


def rows_of_parts(source: DataFrame, part: str, parts: DataFrame) -> DataFrame | None:
    """Rows of `source` whose part is listed in `parts`; None for an empty list.

    A list of checked size becomes a literal partition filter, so only the
    folders of those parts are read; a longer one is a semi-join.
    """
    names = parts.select(F.col("file_suffix").alias(part)).distinct()
    values = [r[0] for r in names.limit(PRUNED_PARTS + 1).collect()]
    if not values:
        return None
    if len(values) > PRUNED_PARTS:
        return source.join(names, source[part].eqNullSafe(names[part]), "left_semi")
    wanted = F.col(part).isin([v for v in values if v is not None])
    return source.where(wanted | F.col(part).isNull() if None in values else wanted)


def part_files(source: DataFrame, part: str) -> DataFrame:
    """Columns (part, csv_file, file_size, mtime): what the listing says of every part.

    No column of the data is read. Rows that come from no file have nulls.
    """
    name = F.col(part).alias("part")
    try:
        files = source.select(
            name, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
        ).distinct()
    except AnalysisException:
        kinds = zip(("csv_file", "file_size", "mtime"), ("string", "bigint", "timestamp"))
        return source.select(name).distinct().select(
            "part", *[F.lit(None).cast(kind).alias(column) for column, kind in kinds]
        )
    return files.groupBy("part").agg(
        F.min("file_path").alias("csv_file"),
        F.sum("file_size").alias("file_size"),
        F.max("file_modification_time").alias("mtime"),
    )


def part_listing(spark: SparkSession, path: str, part: str) -> DataFrame:
    """What `part_files` tells, of a folder with one subfolder for each part, from its listing.

    No file is opened, so a broken one does no harm here.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "part string, csv_file string, file_size long, mtime timestamp")
    return files.groupBy(folder_value(F.col("path"), part).alias("part")).agg(
        F.min("path").alias("csv_file"),
        F.sum("length").alias("file_size"),
        F.max("modificationTime").alias("mtime"),
    )


OUTCOME_SCHEMA = "table_name string, file_suffix string, status string, row_count long, error_message string"


def load_folder(
    target: Target,
    table: str,
    path: str,
    schema: T.StructType,
    part: str,
    identity: str = BY_SUFFIX,
    attempts: int = 2,
) -> DataFrame:
    """Load the parts below `path`; one outcome (`OUTCOME_SCHEMA`) for each of them.

    The listing alone tells which parts are known: those are ``skipped`` and none of their
    files is opened. The others are one job. If it fails, its parts are halved and each half
    is tried by itself, so a broken part keeps no other from being ``loaded``; one that
    fails alone is tried `attempts` times in all, and is ``failed`` with the message. It has
    no history row, so the next load tries it again. By hash, a part whose content was
    loaded under another name is ``skipped`` too.
    """
    spark = target.spark
    listing = materialize(part_listing(spark, path, part), "listing")
    if listing.isEmpty():
        return spark.createDataFrame([], OUTCOME_SCHEMA)
    todo = _open_names(listing, target, table, identity)
    todo = materialize(todo.withColumn("h", F.xxhash64("file_suffix")), "open")
    source = spark.read.schema(T.StructType([*[f for f in schema if f.name != part], T.StructField(part, T.StringType())])).parquet(path)
    outcomes = listing.join(todo, listing["part"].eqNullSafe(todo["file_suffix"]), "left_anti").select(
        F.lit(table).alias("table_name"), F.col("part").alias("file_suffix"), F.lit("skipped").alias("status"),
        F.lit(None).cast("long").alias("row_count"), F.lit("").alias("error_message"),
    )
    groups, tries = [(-(1 << 63), (1 << 63) - 1)], 0
    while groups:
        first, last = groups.pop()
        own = todo.where(F.col("h").between(first, last))
        rows = rows_of_parts(source, part, own)
        if rows is None:
            continue
        mine = listing.join(own, listing["part"].eqNullSafe(own["file_suffix"]), "left_semi")
        try:
            entries = load_parts(target, table, rows, part, identity, files=mine)
        except Exception as error:
            if first < last and own.limit(2).count() > 1:
                middle = (first + last) // 2
                groups += [(middle + 1, last), (first, middle)]
                continue
            tries += 1
            if tries < attempts:
                groups.append((first, last))
                continue
            found = own.select("file_suffix", F.lit("failed").alias("status"), F.lit(None).cast("long").alias("row_count"), F.lit(str(error)).alias("error_message"))
        else:
            loaded = entries.select(F.col("file_suffix").alias("name"), F.col(ROW_COUNT).alias("row_count"))
            found = own.join(loaded, own["file_suffix"].eqNullSafe(loaded["name"]), "left").select(
                "file_suffix",
                F.when(F.col("row_count").isNotNull(), "loaded").otherwise("skipped").alias("status"),
                "row_count",
                F.lit("").alias("error_message"),
            )
        tries = 0
        outcomes = outcomes.unionByName(found.select(F.lit(table).alias("table_name"), "*"))
    return materialize(outcomes, "outcomes")


def _open_names(files: DataFrame, target: Target, table: str, identity: str) -> DataFrame:
    """Names of the parts that may have to be loaded, as ``file_suffix``.

    By suffix: names the history does not hold. By hash and by files: all but the parts
    whose files are those of an earlier load, by name, size and time.
    """
    history = target.history().where(F.col("table_name") == table)
    if identity in (BY_HASH, BY_FILES):
        scope = "job_name" if identity == BY_HASH else "schema_name"
        known = history.where(F.col(scope) == (target.job if identity == BY_HASH else target.schema))
        same = known["file_suffix"].eqNullSafe(files["part"])
        for column in ("csv_file", "file_size", "mtime"):
            same = same & (known[column] == files[column])
    else:
        known = history.where(F.col("schema_name") == target.schema)
        same = known["file_suffix"].eqNullSafe(files["part"])
    return files.join(known, same, "left_anti").select(F.col("part").alias("file_suffix"))


def load_parts(
    target: Target,
    table: str,
    source: DataFrame,
    part: str,
    identity: str = BY_SUFFIX,
    retry: bool = False,
    gather: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """Load the parts of `source` not loaded before; returns their history rows.

    A part is a partition of the table: loading it again overwrites it. By hash the
    partition is the job and the content, so a table is loaded either by suffix or by
    hash. The history is written after the data, so a job that dies in between repeats
    the same parts and doubles nothing. ``retry`` loads every part of `source`
    again, whatever the history says. `files` tells the parts' files (`part_listing`),
    which otherwise takes a scan without columns.
    """
    files = part_files(source, part) if files is None else files
    if not retry:
        # names and files first: what is known is neither counted nor read
        open_names = _open_names(files, target, table, identity)
        found = rows_of_parts(source, part, open_names)
        source = source.limit(0) if found is None else found
    parts = manifest(source, part, identity)
    if not retry:
        parts = pending_parts(parts, target.history(), target, table, identity)
    same_part = parts["file_suffix"].eqNullSafe(files["part"])
    entries = parts.join(files, same_part, "left").select(
        F.lit(target.job).alias("job_name"),
        F.lit(target.schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        "file_suffix",
        "file_hash",
        F.col(ROW_COUNT),
        "csv_file",
        "file_size",
        "mtime",
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
    )
    # fixed once: the data and the history must speak of the same parts
    entries = materialize(entries, "pending")
    rows = rows_of_parts(source, part, entries)
    if rows is not None:
        key = part
        if identity == BY_HASH:
            key = LOAD_KEY
            slices = entries.select(
                F.col("file_suffix").alias("_part"), F.concat_ws("-", "job_name", "file_hash").alias(key)
            )
            rows = rows.join(slices, rows[part].eqNullSafe(slices["_part"])).drop("_part")
        replace_slices(rows, target.table_path(table), [key], gather)
        entries.write.mode("append").parquet(target.history_path)
    return entries


def load_status(parts: DataFrame, templates: DataFrame, history: DataFrame) -> DataFrame:
    """``skipped`` (no template, or loaded before) or ``pending`` for every part.

    `parts` has (table_name, file_suffix), `templates` (table_name), `history`
    as kept by a `Target`.
    """
    names = templates.select("table_name").distinct()
    if is_small(names, BROADCAST_TEMPLATES):
        names = F.broadcast(names)
    known = names.withColumn("_known", F.lit(True))
    done = history.select("table_name", "file_suffix").distinct().withColumn("_done", F.lit(True))
    return (
        parts.join(known, "table_name", "left")
        .join(done, ["table_name", "file_suffix"], "left")
        .withColumn(
            "status",
            F.when(F.col("_known").isNull() | F.col("_done").isNotNull(), "skipped").otherwise(
                "pending"
            ),
        )
        .drop("_known", "_done")
    )


def load_summary(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of loaded, skipped and failed outcomes."""
    return outcomes.groupBy(*(by or [])).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("loaded", "skipped", "failed")]
    )


def match_templates(files: DataFrame, templates: DataFrame, how: str = "inner") -> DataFrame:
    """Files with their template by name; ``left_anti`` gives files without one."""
    return files.join(templates, "template", how)


# --- catalog tables -----------------------------------------------------------


def create_or_append(spark: SparkSession, df: DataFrame, table: str, path: str) -> None:
    """Create `table` from `df`, or append to it by column position."""
    if spark.catalog.tableExists(table):
        df.write.insertInto(table)
    else:
        df.write.option("path", path).format("parquet").saveAsTable(table)


def append_by_name(df: DataFrame, table: str, path: str) -> None:
    """Create `table` from `df`, or append to it by column name."""
    df.write.option("path", path).format("parquet").mode("append").saveAsTable(table)
