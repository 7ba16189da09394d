"""Sinks: partitioned Parquet and CSV, slice replacement, kept versions, typed conversion."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.session import delete_path
from parampipe.sources.files import CSV_FORMAT, infer_types

# A gzip file is read by one task, so no CSV file gets more rows than this.
# Fixed value: the row count of one extract chunk.
CSV_ROWS_PER_FILE = 1_000_000

# Types and the keywords that name them; the first type that fits wins.
TYPE_RULES = (
    ("string", ("ID", "CODE", "KEY", "NO", "SEQ")),
    ("numeric", ("AMT", "AMOUNT", "RATE", "CNT", "COUNT", "QTY")),
)
TypeRules = tuple[tuple[str, tuple[str, ...]], ...]

# Fixed value: versions kept when an output is written again.
KEEP_VERSIONS = 10


def by_case(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring the rows of a case together before a partitioned write.

    Without it every task writes a file per case. REBALANCE lets the adaptive
    planner split a case that holds much of the data over many tasks and pack
    small cases together.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


def write_parquet(
    df: DataFrame,
    path: str,
    keys: list[str] | None = None,
    mode: str = "errorifexists",
    gather: bool = True,
) -> None:
    """Parquet (snappy), one partition folder per case of `keys`.

    `gather=False` skips the shuffle for rows already laid out by case.
    """
    if not keys:
        df.write.mode(mode).parquet(path)
        return
    rows = by_case(df, keys) if gather else df
    rows.write.mode(mode).partitionBy(*keys).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    keys: list[str] | None = None,
    compression: str = "gzip",
    mode: str = "errorifexists",
) -> None:
    """CSV with a header in every file; files appear only when the job commits.

    A gzip file cannot be split when it is read, and compressing costs more
    than a shuffle: rows are spread evenly over files of moderate size first.
    """
    if keys:
        rows = by_case(df, keys)
    else:
        rows = df.hint("rebalance") if compression == "gzip" else df
    writer = (
        rows.write.mode(mode)
        .options(**CSV_FORMAT, compression=compression)
        .option("maxRecordsPerFile", CSV_ROWS_PER_FILE)
    )
    if keys:
        writer = writer.partitionBy(*keys)
    writer.csv(path)


def write_extract(
    df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", compression: str = "gzip"
) -> None:
    """Write an extract in the job's format (``csv`` or ``parquet``)."""
    if fmt == "csv":
        write_csv(df, path, keys, compression)
    elif fmt == "parquet":
        write_parquet(df, path, keys)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def observe_rows(df: DataFrame, name: str = "extract") -> tuple[DataFrame, Observation]:
    """`df` counted on the way through: the write that follows also yields the count."""
    progress = Observation(name)
    return df.observe(progress, F.count(F.lit(1)).alias("rows")), progress


def replace_slices(df: DataFrame, path: str, keys: list[str], gather: bool = True) -> None:
    """Replace exactly the partitions that occur in `df`; others stay untouched.

    Running it again gives the same table, so a retry never doubles rows.
    """
    rows = by_case(df, keys) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def case_files(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Files below `path`, in any format, with the case their folders name: columns
    `_file` and `keys`. Taken from the file listing; no file is opened."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(["`_file` string", *[f"`{k}` string" for k in keys]]))
    return files.select(
        F.col("path").alias("_file"), *[folder_value(F.col("path"), k).alias(k) for k in keys]
    )


def existing_cases(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Distinct case keys written below `path`, in any format."""
    return case_files(spark, path, keys).select(*keys).distinct()


def drop_stale_slices(
    spark: SparkSession, path: str, before: DataFrame, cases: DataFrame, keys: list[str]
) -> None:
    """Remove the partitions of `cases` that a rerun left as they were: it had no rows for them.

    `before` are the `case_files` from ahead of the rerun; what it wrote has new names.
    One folder name per stale partition comes to the driver.
    """
    now = case_files(spark, path, keys)
    same = [now[k].eqNullSafe(cases[k].cast("string")) for k in keys]
    left = now.join(cases, same, "left_semi").join(before.select("_file"), "_file", "left_semi")
    folders = left.select(F.regexp_replace("_file", r"/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        delete_path(spark, row["folder"])


def folder_value(path: Column, key: str) -> Column:
    text = F.regexp_extract(path, rf"/\Q{key}\E=([^/]*)/", 1)
    # folder names are %-escaped, and '+' stands for itself
    value = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__"))


# --- versions ---------------------------------------------------------------


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Keep the output of a run beside the earlier ones, under ``version=``."""
    replace_slices(df.withColumn("version", F.lit(version)), path, ["version"], gather=False)


def kept_versions(versions: DataFrame, keep: int = KEEP_VERSIONS) -> DataFrame:
    """The newest `keep` rows of a (version) list."""
    return versions.orderBy(F.col("version").desc()).limit(keep)


def read_versions(
    spark: SparkSession, path: str, schema: T.StructType, keep: int = KEEP_VERSIONS
) -> DataFrame:
    """Rows of the newest `keep` versions below `path`."""
    newest = kept_versions(existing_cases(spark, path, ["version"]), keep).collect()
    fields = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    table = spark.read.schema(fields).parquet(path)
    return table.where(F.col("version").isin([r["version"] for r in newest]))


def remove_versions(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Delete the folders of all but the newest `keep` versions below `path`; which they were.

    Safe to repeat: the newest are told by their names, from the file listing, so a run that
    was broken off leaves only folders that the next one deletes. One name per version comes
    to the driver. A version of NULL is older than any other.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    found = [r["version"] for r in existing_cases(spark, path, ["version"]).collect()]
    stale = sorted(found, key=lambda v: (v is not None, v or ""))[: max(0, len(found) - keep)]
    names = {*stale}
    files = case_files(spark, path, ["version"]).where(F.col("version").isin([*names - {None}]) | (F.col("version").isNull() if None in names else F.lit(False)))
    folders = files.select(F.regexp_extract("_file", r"^(.*/version=[^/]*)/", 1).alias("folder")).distinct()
    for row in folders.toLocalIterator():
        delete_path(spark, row["folder"])
    return stale


def keep_latest(
    df: DataFrame, group: list[str], order: list[Column], keep: int = KEEP_VERSIONS
) -> DataFrame:
    """The first `keep` rows of every group in `order`.

    The filter on the row number lets Spark cut every group to `keep` rows
    before the shuffle, so a group with most of the rows sends few of them.
    """
    position = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("position", position).where(F.col("position") <= keep)


# --- typed conversion --------------------------------------------------------


def types_by_name(names: list[str], rules: TypeRules = TYPE_RULES) -> dict[str, str]:
    """Type of every name that holds a keyword of `rules`, in any case."""
    found: dict[str, str] = {}
    for kind, keywords in reversed(rules):
        found.update({n: kind for n in names for k in keywords if k.lower() in n.lower()})
    return found


def finite_number(value: Column) -> Column:
    """The text as a double; NULL for what is no number."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def typed_columns(
    raw: DataFrame, inferred: T.StructType, rules: TypeRules = TYPE_RULES
) -> list[Column]:
    """Typed columns of an all-text frame; text that is no number becomes NULL."""
    by_name = types_by_name(inferred.fieldNames(), rules)
    convert = {"string": lambda c: c.cast("string"), "numeric": finite_number}
    return [
        convert.get(by_name.get(f.name), lambda c, f=f: c.cast(f.dataType))(F.col(f"`{f.name}`")).alias(f.name)
        for f in inferred.fields
    ]


def convert_typed(raw: DataFrame, path: str, rules: TypeRules = TYPE_RULES) -> None:
    """Write an all-text frame as typed Parquet.

    Types come from the column names where `rules` name one; only the other
    columns are looked at to find theirs. Dates stay text.
    """
    by_name = types_by_name(raw.columns, rules)
    open_columns = [c for c in raw.columns if c not in by_name]
    found = infer_types(raw.select(*open_columns), dates=False) if open_columns else T.StructType()
    types = {f.name: f.dataType for f in found.fields}
    schema = T.StructType(
        [T.StructField(c, types.get(c, T.StringType())) for c in raw.columns]
    )
    raw.select(*typed_columns(raw, schema, rules)).write.parquet(path)
