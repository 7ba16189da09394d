"""Exact row numbers over ordered data without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parampipe.session import materialize

_ID, _PART = "_ordinal_id", "_ordinal_part"
_FIRST, _SIZE, _BEFORE = "_ordinal_first", "_ordinal_size", "_ordinal_before"
# monotonically_increasing_id keeps the partition in its upper 31 bits
_ROW_BITS = 33


def with_ordinal(
    df: DataFrame, order: list[Column], name: str, group: list[str] | None = None
) -> DataFrame:
    """Add the 1-based position of every row in `order`, within its `group`.

    Rows are range-partitioned by group and order and written once; a row's
    position is its place in its partition plus the sizes of the earlier
    partitions. Only one record per partition and group is ever ordered in one
    place, so a group holding most of the rows is spread like any other. `order`
    must be total.
    """
    keys = [F.col(g) for g in group or []]
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_ID, F.monotonically_increasing_id())
    )
    rows = materialize(ranged, "ordinal").withColumn(
        _PART, F.shiftright(F.col(_ID), _ROW_BITS)
    )
    blocks = rows.groupBy(*(group or []), _PART).agg(
        F.min(_ID).alias(_FIRST), F.count(F.lit(1)).alias(_SIZE)
    )
    earlier = W.partitionBy(*(group or [F.lit(0)])).orderBy(_PART).rowsBetween(
        W.unboundedPreceding, -1
    )
    offsets = blocks.withColumn(_BEFORE, F.coalesce(F.sum(_SIZE).over(earlier), F.lit(0)))
    joined = rows.alias("r").join(
        offsets.drop(_SIZE).alias("o"),
        [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*(group or []), _PART]],
    )
    position = F.col(_ID) - F.col(_FIRST) + F.col(_BEFORE) + 1
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], position.alias(name))
