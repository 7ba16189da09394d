"""What changed between two deliveries of the same rows.

Rows fall into buckets by the hash of their key; a bucket's digest is a row count and
sums of row hashes, so digests of buckets add up to those of the nodes above them. Two
trees of digests are compared from the root down, and only rows below nodes that differ
are shuffled and compared themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.functions.hashing import ROW_COUNT, content_sums
from parampipe.session import is_small, materialize

# Rows of a leaf, about, and the most leaves (2 ** 40 digests are never needed).
LEAF_ROWS = 4096
MOST_BITS = 30
# Bits a step goes down.
STEP = 8
# Differing nodes that are sent to every task; beyond them the level above is used.
MOST_NODES = 100_000

ADDED, REMOVED, CHANGED = "added", "removed", "changed"
OLD, NEW = "old", "new"
_NODE, _COUNTS = "_node", ("_old", "_new")


@dataclass(frozen=True)
class Digests:
    """Digests of 2 ** `bits` buckets: `_node`, a row count and content sums. Written with a
    part they spare the next comparison its pass over the old rows."""

    frame: DataFrame
    bits: int
    keys: tuple[str, ...]
    columns: tuple[str, ...]


def leaf_bits(rows: int) -> int:
    """Bits that give leaves of about `LEAF_ROWS` rows."""
    return min(MOST_BITS, max(0, (rows // LEAF_ROWS).bit_length()))


def bucket(keys: tuple[str, ...], bits: int) -> Column:
    """The first `bits` bits of the key's hash."""
    columns = [F.col(f"`{k}`") for k in keys]
    hashed = F.xxhash64(*columns, *[c.isNull() for c in columns])
    return F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0).cast("long")


def digests(rows: DataFrame, keys: list[str], bits: int | None = None) -> Digests:
    """Digests of `rows`; map-side combined, at most one record per leaf and task."""
    if bits is None:
        bits = leaf_bits(rows.count())
    columns = tuple(sorted(rows.columns))
    sums = content_sums(rows, list(columns), whole_pattern=True)
    leaves = rows.groupBy(bucket(tuple(keys), bits).alias(_NODE)).agg(F.count(F.lit(1)).alias(ROW_COUNT), *sums)
    return Digests(materialize(leaves, "digests"), bits, tuple(keys), columns)


def merge(first: Digests, second: Digests) -> Digests:
    """Digests of the rows of both."""
    if (first.bits, first.keys, first.columns) != (second.bits, second.keys, second.columns):
        raise ValueError("digests of different trees")
    both = first.frame.unionByName(second.frame)
    return Digests(_summed(both, F.col(_NODE)), first.bits, first.keys, first.columns)


def _summed(frame: DataFrame, node: Column) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in frame.columns if c != _NODE]
    return frame.groupBy(node.alias(_NODE)).agg(*sums)


def differing_nodes(old: Digests, new: Digests, most: int = MOST_NODES) -> tuple[DataFrame, int]:
    """Nodes (`_node`) whose rows differ, and their level: the lowest with at most `most` of
    them. The root alone is level 0; no node if both hold the same rows."""
    if (old.bits, old.keys, old.columns) != (new.bits, new.keys, new.columns):
        raise ValueError("digests of different trees")
    found, level = None, 0
    for depth in [*range(0, old.bits, STEP), old.bits]:
        sides = []
        for side in (old, new):
            frame = side.frame
            if found is not None:
                above = F.shiftrightunsigned(_NODE, old.bits - level)
                # at most `most` rows
                frame = frame.withColumn("_above", above).join(
                    F.broadcast(found.withColumnRenamed(_NODE, "_above")), "_above", "left_semi"
                ).drop("_above")
            sides.append(_summed(frame, F.shiftrightunsigned(_NODE, old.bits - depth)))
        values = [c for c in sides[0].columns if c != _NODE]
        left = sides[0].select(_NODE, F.struct(*values).alias("_a"))
        right = sides[1].select(_NODE, F.struct(*values).alias("_b"))
        unequal = left.join(right, _NODE, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(_NODE)
        unequal = materialize(unequal, "nodes")
        if found is not None and not is_small(unequal, most):
            break
        found, level = unequal, depth
        if found.isEmpty():
            break
    return found, level


def part_difference(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    old_digests: Digests | None = None,
    most: int = MOST_NODES,
) -> DataFrame:
    """The rows in which `new` differs from `old`: `change`, `side`, `times` and all columns.

    A row found more often in one delivery is listed with how many times more, `side`
    saying which. Rows of a key that differ on both sides are `changed`, those of any other
    key `added` or `removed`. Keys may be NULL or repeated, NULLs are equal, the order of
    columns does not matter. Both need the same columns with the same types, or it raises;
    two empty or equal deliveries give no rows. Columns must be comparable (no maps).
    """
    kinds = [{f.name: f.dataType.simpleString() for f in d.schema.fields} for d in (old, new)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"deliveries differ in columns: {sorted({*kinds[0].items()} ^ {*kinds[1].items()})}")
    reserved = {"change", "side", "times", _NODE, *_COUNTS} & {c.lower() for c in old.columns}
    if reserved:
        raise ValueError(f"columns with names of the result: {sorted(reserved)}")
    if old_digests is None:
        old_digests = digests(old, keys, leaf_bits(max(old.count(), new.count())))
    nodes, level = differing_nodes(old_digests, digests(new, keys, old_digests.bits), most)
    return _compare(rows_below(old, nodes, level, keys), rows_below(new, nodes, level, keys), keys)


def rows_below(rows: DataFrame, nodes: DataFrame, level: int, keys: list[str]) -> DataFrame:
    """The rows whose key lies below one of `nodes`, found without a shuffle of `rows`."""
    marked = rows.withColumn(_NODE, bucket(tuple(keys), level))
    # at most MOST_NODES rows, or the root
    return marked.join(F.broadcast(nodes), _NODE, "left_semi").drop(_NODE)


def _compare(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in new.columns]
    sides = [
        df.select(*columns, *[F.lit(int(i == k)).cast("long").alias(n) for k, n in enumerate(_COUNTS)])
        for i, df in enumerate((old, new))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(*[F.sum(n).alias(n) for n in _COUNTS])
    more = F.col("_new") - F.col("_old")
    unequal = counted.where(more != 0).select(
        *columns, F.when(more > 0, NEW).otherwise(OLD).alias("side"), F.abs(more).alias("times")
    )
    unequal = materialize(unequal, "difference")
    # sides of a key, combined before the shuffle: a key with most of the rows is no group
    names = [f"_key{i}" for i in range(len(keys))]
    of_key = unequal.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(
        F.min("side").alias("_least"), F.max("side").alias("_most")
    )
    same = [unequal[f"`{k}`"].eqNullSafe(of_key[n]) for k, n in zip(keys, names)]
    change = F.when(F.col("_least") != F.col("_most"), CHANGED).when(F.col("side") == NEW, ADDED).otherwise(REMOVED)
    return unequal.join(of_key, same).select(change.alias("change"), "side", "times", *columns)
