"""Content fingerprints that do not depend on files, row order or encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT = "fingerprint"
ROW_COUNT = "row_count"

# Widths of the pieces a 64-bit row hash is cut into before summing: sums of
# 22-bit pieces stay within a long for more than 10^12 rows per part.
_PIECE_BITS = 22
_SEEDS = (0, 1)


def row_hash(df: DataFrame, columns: list[str], seed: int, whole_pattern: bool = False) -> Column:
    """64-bit hash of a row.

    The hash of a NULL is the seed of its column, so rows that differ only in
    which column is NULL would collide; the NULL pattern is hashed as well, of the
    columns that can be NULL or, to compare tables, of all (`whole_pattern`).
    """
    nullable = {f.name for f in df.schema.fields if f.nullable or whole_pattern}
    flags = [F.col(c).isNull() for c in columns if c in nullable]
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *flags)


def content_sums(df: DataFrame, columns: list[str], whole_pattern: bool = False) -> list[Column]:
    """Sums of the pieces of the row hashes: those of two sets of rows add up to those of both."""
    mask = (1 << _PIECE_BITS) - 1
    pieces = []
    for seed in _SEEDS:
        h = row_hash(df, columns, seed, whole_pattern)
        for shift in (0, _PIECE_BITS, 2 * _PIECE_BITS):
            pieces.append(F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(mask))))
    return [p.alias(f"_piece{i}") for i, p in enumerate(pieces)]


def fingerprint(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Row count and content fingerprint of every group of `by`.

    The sums are plain long aggregates: combined before the shuffle, so a group
    holding most of the rows costs one small record per task. Equal rows count
    as often as they occur.
    """
    hashed = columns or [c for c in df.columns if c not in by]
    pieces = content_sums(df, hashed)
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias(ROW_COUNT), *pieces)
    names = [f"_piece{i}" for i in range(len(pieces))]
    parts = [F.col(c).cast("string") for c in [ROW_COUNT, *names]]
    return grouped.withColumn(FINGERPRINT, F.sha2(F.concat_ws(":", *parts), 256)).drop(*names)


def text_digests(text: Column) -> list[Column]:
    """MD5 and SHA-256 of a whole text."""
    return [F.md5(text).alias("md5_text"), F.sha2(text, 256).alias("sha256_text")]
