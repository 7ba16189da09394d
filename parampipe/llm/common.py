"""Helpers the operators share: row identity, scratch tables, connected components."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.session import materialize


def ship_with_tasks(module: str) -> None:
    """Send the functions of `module` along with the tasks, so that executors need
    no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_with_tasks(__name__)

ID = "doc_id"
TEXT = "text"


def whole_text(column: str = TEXT) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_hash(column: str = TEXT) -> Column:
    """Tells rows that share a doc_id apart; null and empty text are the same."""
    return F.xxhash64(whole_text(column))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def same_row(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs, as one join condition."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Columns (node, root): every node of `edges` (a, b) with the least node it reaches.

    Large-star and small-star rounds: each node hands all its neighbours to the
    least one it knows, first the greater neighbours, then the smaller ones, until
    nothing changes. Minima are pre-aggregated before the shuffle and joined
    back, so a node with very many neighbours is a skewed join, which adaptive
    execution splits, never one group. Every round is written to the shared
    folder; nothing is collected but two numbers a round.
    """
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    links = edges.where("a <> b").select(hi.alias("hi"), lo.alias("lo")).distinct()
    links = materialize(links, label)
    before = None
    while True:
        state = links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.count_distinct("hi")
        ).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        links = materialize(_small_star(_large_star(links)), label)
    members = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return members.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    kept = least.select("hi", F.col("m").alias("lo"))
    return kept.unionByName(moved).distinct()
