"""File sources: CSV, Parquet, template folders and file inventories."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV as other tools write it: quotes doubled inside quoted text, spaces kept,
# microseconds kept. Readers and writers share these.
CSV_FORMAT: dict[str, str | bool] = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "encoding": "UTF-8",
}

# A missing field is NULL and a quoted empty field is an empty text. With the
# default NULL text (empty) a reader takes both for NULL; no field holds this one.
_READ_FORMAT = {**CSV_FORMAT, "nullValue": "\x00"}

_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV (plain or compressed) with a known schema; `multi_line` for text with line breaks."""
    return spark.read.options(**_READ_FORMAT, multiLine=multi_line).schema(schema).csv(path)


def read_csv_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with every column as text."""
    return spark.read.options(
        **_READ_FORMAT, inferSchema=False, multiLine=multi_line
    ).csv(path)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int, multi_line: bool = False
) -> DataFrame:
    """Files of a folder (plain or compressed CSV) as a stream, as `read_csv` reads them."""
    reader = spark.readStream.options(**_READ_FORMAT, multiLine=multi_line).schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(path)


# Classes of a text, one bit each, in the order in which a column takes its type.
# A whole number is a number too; all other classes shut each other out.
_CLASSES: tuple[tuple[int, T.DataType], ...] = (
    (1, T.LongType()),
    (2, T.DoubleType()),
    (4, T.DateType()),
    (8, T.TimestampNTZType()),
    (16, T.BooleanType()),
)


def infer_types(raw: DataFrame, dates: bool = True) -> T.StructType:
    """Type of every text column, from one aggregation over all values.

    Whole numbers become bigint, other numbers double, then (with `dates`) date
    and timestamp, and boolean; anything else, text with leading zeros, and a
    column of NULLs stay text. A row's classes are one array and a column's are
    folded by `bit_and`, so a task sends one row however many cells it reads; one
    function over the array keeps the plan small however many columns there are.
    """
    if not raw.columns:
        return T.StructType()
    cells = F.array(*[F.col(f"`{c}`") for c in raw.columns])
    classes = raw.select(F.transform(cells, lambda value: _class_mask(value, dates)).alias("m"))
    row = classes.agg(*[F.bit_and(F.col("m")[i]).alias(f"c{i}") for i in range(len(raw.columns))]).first()
    return T.StructType([T.StructField(c, _type_of(mask)) for c, mask in zip(raw.columns, row)])


def _type_of(mask: int | None) -> T.DataType:
    """The first type whose class all values have."""
    return next((t for bit, t in _CLASSES if (mask or 0) & bit), T.StringType())


def _class_mask(value: Column, dates: bool) -> Column:
    """Bits of the classes a text belongs to, 0 for none; NULL has every class."""
    mask = F.when(value.isNull(), F.lit(None).cast("int"))
    mask = mask.when(_is_whole_number(value), 1 | 2)
    mask = mask.when(_looks_numeric(value) & value.try_cast("double").isNotNull(), 2)
    if dates:
        size = F.length(value)
        mask = mask.when(
            (size == 10) & value.rlike(_DATE) & value.try_cast("date").isNotNull(), 4
        ).when(
            (size >= 19) & value.rlike(_TIMESTAMP) & value.try_cast("timestamp_ntz").isNotNull(), 8
        )
    return mask.when(F.lower(value).isin("true", "false"), 16).otherwise(0)


def _is_whole_number(value: Column) -> Column:
    """Text is a bigint without leading zeros. Text tests only: a failing cast
    costs an exception per row."""
    digits = F.when(value.startswith("-"), F.substring(value, 2, 2**31 - 1)).otherwise(value)
    size = F.length(digits)
    return (
        (size > 0)
        & (F.translate(digits, "0123456789", "") == "")
        & ((digits == "0") | ~digits.startswith("0"))
        & ((size < 19) | ((size == 19) & (digits <= "9223372036854775807")))
    )


def _looks_numeric(value: Column) -> Column:
    """Cheap test ahead of a cast: only characters of a number, no inner minus
    without an exponent, no leading zero."""
    digits = F.ltrim(value, F.lit("+-"))
    leading_zero = digits.startswith("0") & F.substring(digits, 2, 1).between("0", "9")
    dated = (F.locate("-", value, 2) > 0) & ~F.lower(value).contains("e")
    return (F.translate(value, "0123456789+-.eE", "") == "") & ~leading_zero & ~dated


def cast_to(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with inferred types. Reads the files twice; give a schema where one is known."""
    raw = read_csv_raw(spark, path, multi_line)
    return cast_to(raw, infer_types(raw))


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet; a given schema also fixes the types of the partition columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at `path`, or no rows when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def file_inventory(
    spark: SparkSession, path: str, with_hash: bool = False, pattern: str = "*"
) -> DataFrame:
    """Path, size and modification time of every file below `path`, backups excluded.

    The content is read only for `with_hash`; a file is then one record, so use
    it for files of moderate size and `hashing.fingerprint` for data.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .where(~F.col("path").contains("/_backup/"))
    )
    columns = [F.col("path"), F.col("length").alias("file_size"), F.col("modificationTime")]
    if with_hash:
        columns.append(F.sha2(F.col("content"), 256).alias("file_hash"))
    return files.select(*columns)


def template_corpus(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row per ``.sql`` file below `path`: relative path, folder, stem, text."""
    base = path.rstrip("/") + "/"
    texts = (
        spark.read.option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", "*.sql")
        .text(path, wholetext=True)
    )
    relative = F.element_at(F.split(F.col("_metadata.file_path"), _quoted(base)), -1)
    return texts.select(relative.alias("sql_path"), F.col("value").alias("text")).select(
        "sql_path",
        folder_of(F.col("sql_path")).alias("folder"),
        F.regexp_replace(F.element_at(F.split("sql_path", "/"), -1), r"\.sql$", "").alias("stem"),
        "text",
    )


def folder_of(path: Column) -> Column:
    """Folder part of a relative path, empty for a file at the top."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise("")


def _quoted(text: str) -> str:
    return r"\Q" + text.replace("\\E", r"\E\\E\Q") + r"\E"
