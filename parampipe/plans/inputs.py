"""Input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temp views, for templates and SQL steps that name their tables."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
