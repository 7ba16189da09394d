"""Name filters for templates, parts and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_any(column: Column, patterns: str | list[str]) -> Column:
    """`column` contains one of the patterns, ignoring case (comma text or list)."""
    items = patterns.split(",") if isinstance(patterns, str) else patterns
    wanted = [p.strip().lower() for p in items]
    lowered = F.lower(column)
    test = F.lit(False)
    for pattern in wanted:
        test = test | lowered.contains(pattern)
    return test


def in_folders(folder: Column, folders: list[str]) -> Column:
    """Folder is one of `folders`; slashes around them and backslashes do not matter."""
    return folder.isin([f.strip().replace("\\", "/").strip("/") for f in folders])


def suffix_has_values(suffix: Column, values: list[str]) -> Column:
    """Every value occurs in the suffix; parts without a suffix always pass."""
    test = F.lit(True)
    for value in values:
        test = test & suffix.contains(value)
    return (suffix == "") | test


def for_targets(parts: DataFrame, name: Column, targets: DataFrame, target: Column) -> DataFrame:
    """Parts whose upper-case table name is among the targets of this run."""
    names = targets.select(F.upper(target).alias("_target")).distinct()
    keyed = parts.withColumn("_target", F.upper(name))
    return keyed.join(names, "_target", "left_semi").drop("_target")
