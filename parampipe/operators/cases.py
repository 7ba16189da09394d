"""Case tables: one row per combination of parameter values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.functions.params import expand_spec


def case_table(
    spark: SparkSession,
    params: dict[str, str],
    names: list[str] | None = None,
    mode: str = "product",
) -> DataFrame:
    """Cases over the parameters in `names` (default: all), one column each.

    ``product`` gives every combination, ``zip`` pairs the values by position
    and stops at the shortest list.
    """
    used = sorted(params if names is None else names)
    unknown = [n for n in used if n not in params]
    if unknown:
        raise ValueError(f"missing params {unknown}")
    specs = {n: F.lit(str(params[n])) for n in used}
    return expand_cases(spark.range(0, 1, 1, 1).select(), specs, mode)


def expand_cases(df: DataFrame, specs: dict[str, Column], mode: str = "product") -> DataFrame:
    """Expand every row of `df` into its cases.

    Both modes are generators over arrays held in the row, so no join and no
    pairing of rows takes place.
    """
    if not specs:
        return df
    if mode == "product":
        for name, spec in specs.items():
            df = df.select("*", F.explode(expand_spec(spec)).alias(name))
        return df
    if mode == "zip":
        lists = [expand_spec(spec).alias(name) for name, spec in specs.items()]
        packed = df.select("*", F.struct(*lists).alias("_lists"))
        fields = [F.col(f"_lists.{n}") for n in specs]
        shortest = F.array_min(F.array(*[F.size(f) for f in fields]))
        pairs = F.slice(F.arrays_zip(*fields), F.lit(1), shortest)
        exploded = packed.select("*", F.explode(pairs).alias("_pair")).drop("_lists")
        return exploded.select(
            *df.columns, *[F.col("_pair").getField(n).alias(n) for n in specs]
        )
    raise ValueError(f"unknown case mode: {mode}")


def case_params(names: list[str]) -> Column:
    """Map from parameter name to value, built from the case columns."""
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])


def rows_by_case(cases: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Row count of every case, zero for cases without rows.

    Rows are counted before the join, so the join moves one record per case.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return cases.join(counts, keys, "left").withColumn(
        "row_count", F.coalesce(F.col("row_count"), F.lit(0).cast("bigint"))
    )
