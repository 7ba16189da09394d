"""Counts, summaries, column widths and sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows one sheet can hold, name length, column width rule.
SHEET_ROWS = 1_048_576
SHEET_NAME_CHARS = 31
WIDTH_FACTOR = 1.2
WIDTH_PADDING = 2
WIDTH_LIMIT = 50
SUMMARY_WIDTH_LIMIT = 30
BYTES_PER_MB = 1024 * 1024


def megabytes(size: Column) -> Column:
    return F.bround(size / F.lit(BYTES_PER_MB), 2)


def exact_sum(column: str, scale: int = 2) -> Column:
    """Sum of money-like doubles that does not depend on the order of addition."""
    return F.sum(F.col(column).cast(T.DecimalType(18, scale)))


def rows_per_case(df: DataFrame, keys: list[str], amount: str | None = None) -> DataFrame:
    """Row count (and rounded total of `amount`) per case."""
    measures = [F.count(F.lit(1)).alias("row_count")]
    if amount:
        measures.append(F.bround(exact_sum(amount).cast("double"), 2).alias(f"sum_{amount}"))
    return df.groupBy(*keys).agg(*measures)


def group_summary(
    df: DataFrame, folder: str, sheet: str, limit: int = SHEET_ROWS
) -> DataFrame:
    """Rows per sheet, numbered within its folder, with its full and its short name.

    Every sheet is listed; `over_limit` marks those with more rows than a sheet can
    hold. Short names differ within a folder: one that is cut, shared or ends like
    a number of ours carries the sheet's number. The windows run over one record
    per sheet, not over the data.
    """
    counts = df.groupBy(folder, sheet).agg(F.count(F.lit(1)).alias("rows"))
    full = F.upper(F.col(sheet))
    named = counts.select(
        folder,
        F.row_number().over(W.partitionBy(folder).orderBy(sheet)).alias("no"),
        full.alias("full_name"),
        F.substring(full, 1, SHEET_NAME_CHARS).alias("short"),
        "rows",
    )
    shared = F.count(F.lit(1)).over(W.partitionBy(folder, "short")) > 1
    ending = F.concat(F.lit("~"), F.col("no"))
    cut = F.col("short") != F.col("full_name")
    marked = F.concat(F.left("short", SHEET_NAME_CHARS - F.length(ending)), ending)
    clash = cut | shared | F.col("short").rlike(r"~\d+$")
    return named.select(
        folder,
        "no",
        F.when(clash, marked).otherwise(F.col("short")).alias("sheet_name"),
        "full_name",
        "rows",
        (F.col("rows") > limit).alias("over_limit"),
    )


def column_width_profile(df: DataFrame, limit: int = WIDTH_LIMIT) -> DataFrame:
    """Display width of every column, from one aggregation over all columns."""
    longest = df.agg(
        *[
            F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)).alias(f"len_{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    numeric = [isinstance(f.dataType, T.NumericType) for f in df.schema.fields]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.greatest(F.col(f"len_{i}"), F.lit(len(c))).alias("max_len"),
                F.lit(numeric[i]).alias("is_numeric"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    width = (F.col("max_len") * F.lit(WIDTH_FACTOR)).cast("int") + WIDTH_PADDING
    return longest.select(F.inline(rows)).withColumn("width", F.least(width, F.lit(limit)))


def next_sequence(
    df: DataFrame, name: Column, prefix: Column, group: list[str], width: int = 2
) -> DataFrame:
    """Next free ``<prefix>NN`` per group: one above the largest number in use."""
    digits = F.regexp_extract(
        F.when(name.startswith(prefix), F.replace(name, prefix, F.lit(""))), r"^\s*([+-]?\d+)\s*$", 1
    )
    # empty text first: a failing cast costs an exception per row
    used = F.nullif(digits, F.lit("")).try_cast("bigint")
    number = F.coalesce(F.max(used), F.lit(0)) + 1
    return df.groupBy(*group).agg(number.alias("next_no")).withColumn(
        "next_label", F.format_string(f"%0{width}d", F.col("next_no"))
    )
