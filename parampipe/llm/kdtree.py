"""Sharding by a k-d tree over document metadata.

Nodes are cut at weighted medians (weight: bytes) along the dimension in which
they are widest, until a leaf holds the target bytes. All nodes of a level are
cut together: histograms of bytes, pre-aggregated before the shuffle, close in on
each cut; rows that tie on the coordinate are told apart by a hash of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parampipe.llm.common import ID, whole_text
from parampipe.session import materialize

# Histogram buckets of a node in one round.
BUCKETS = 1 << 14
# Bits of the hash of id and text that tell ties apart, and below them of a row number,
# which parts rows that are equal in both.
_HASH_BITS, _COPY_BITS = 40, 16
_TIE_BITS = _HASH_BITS + _COPY_BITS

NODE = ["first", "leaves"]


def metadata_dimensions() -> dict[str, Column]:
    """Coordinates as longs; names by a hash, so that no list of names is needed."""
    return {
        "n_chars": F.coalesce(F.col("n_chars").cast("long"), F.lit(-1).cast("long")),
        "source": F.crc32(F.coalesce(F.col("source").cast("string"), F.lit(""))),
        "lang": F.crc32(F.coalesce(F.col("lang").cast("string"), F.lit(""))),
    }


def tie_breaker(text: Column, row: Column) -> Column:
    """Order of rows with equal coordinates: it depends on the table's layout only among
    rows of one id and text."""
    content = F.shiftrightunsigned(F.xxhash64(ID, text), 64 - _HASH_BITS)
    return F.shiftleft(content, _COPY_BITS).bitwiseOR(F.shiftrightunsigned(F.xxhash64(row), 64 - _COPY_BITS))


def cut_level(rows: DataFrame, dims: list[str]) -> DataFrame:
    """One level deeper: nodes of two leaves or more are cut, others stay.

    `rows` has (first, leaves, size, tie) and the coordinates; a node is named by
    its first leaf and its number of leaves.
    """
    open_rows = rows.where("leaves > 1")
    spread = [F.max(d) - F.min(d) for d in dims]
    nodes = open_rows.groupBy(*NODE).agg(
        F.sum("size").alias("bytes"), *[s.alias(f"w_{d}") for s, d in zip(spread, dims)],
        *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims],
    )
    ends = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first()
    share = {d: F.col(f"w_{d}") / F.lit(float(max(1, ends[d] or 0))) for d in dims}
    widest = F.greatest(*share.values()) if len(dims) > 1 else share[dims[0]]
    pick = F.coalesce(*[F.when(share[d] == widest, F.lit(d)) for d in dims])
    nodes = nodes.withColumn("dim", pick)

    def chosen(prefix: str) -> Column:
        return F.coalesce(*[F.when(F.col("dim") == d, F.col(f"{prefix}{d}")) for d in dims])

    state = nodes.select(
        *NODE,
        "dim",
        F.expr("bytes * (leaves div 2) div leaves").alias("goal"),
        F.lit(0).cast("long").alias("before"),
        chosen("lo_").alias("lo"),
        chosen("hi_").alias("hi"),
    )
    state = materialize(state, "nodes")
    placed = open_rows.join(state.select(*NODE, "dim"), NODE).select(
        *NODE, "size", "tie", chosen("").alias("x")
    )
    while state.where("hi > lo").limit(1).count():
        state = materialize(narrow(placed, state, "x"), "nodes")
    # rows at the coordinate of the cut, by their hash
    ties = placed.join(state.select(*NODE, F.col("lo").alias("cut")), NODE).where("x = cut")
    tie_state = state.select(
        *NODE, "goal", "before", F.lit(0).cast("long").alias("lo"), F.lit((1 << _TIE_BITS) - 1).cast("long").alias("hi")
    )
    while tie_state.where("hi > lo").limit(1).count():
        tie_state = materialize(narrow(ties, tie_state, "tie"), "nodes")
    cuts = state.select(*NODE, "dim", F.col("lo").alias("cut")).join(
        tie_state.select(*NODE, F.col("lo").alias("tie_cut")), NODE
    )
    x = chosen("")
    left = (x < F.col("cut")) | ((x == F.col("cut")) & (F.col("tie") <= F.col("tie_cut")))
    half = F.expr("leaves div 2").cast("int")
    joined = rows.join(cuts, NODE, "left")
    keep = [c for c in rows.columns if c not in NODE]
    return joined.select(
        *keep,
        F.when(F.col("dim").isNull() | left, F.col("first")).otherwise(F.col("first") + half).alias("first"),
        F.when(F.col("dim").isNull(), F.col("leaves"))
        .when(left, half)
        .otherwise(F.col("leaves") - half)
        .alias("leaves"),
    )


def narrow(rows: DataFrame, state: DataFrame, coordinate: str) -> DataFrame:
    """The bucket of each node's interval in which the bytes reach the goal."""
    keep = [c for c in state.columns if c not in ("lo", "hi", "before")]
    width = F.expr(f"greatest(1, (hi - lo + {BUCKETS}) div {BUCKETS})")
    bucket = F.expr(f"({coordinate} - lo) div greatest(1, (hi - lo + {BUCKETS}) div {BUCKETS})")
    inside = F.col(coordinate).between(F.col("lo"), F.col("hi"))
    counted = (
        rows.join(state, NODE)
        .where(inside)
        .groupBy(*NODE, bucket.alias("bucket"))
        .agg(F.sum("size").alias("bytes"))
    )
    upto = W.partitionBy(*NODE).orderBy("bucket")
    total = counted.withColumn("upto", F.sum("bytes").over(upto)).join(state, NODE)
    # the first bucket that reaches the goal, or the last there is
    reached = total.where(F.col("before") + F.col("upto") >= F.col("goal"))
    found = reached.groupBy(*NODE).agg(F.min_by(F.struct("bucket", "upto", "bytes"), "bucket").alias("b"))
    lo = F.col("lo") + F.col("b.bucket") * width
    return state.join(found, NODE).select(
        *keep,
        (F.col("before") + F.col("b.upto") - F.col("b.bytes")).alias("before"),
        lo.alias("lo"),
        F.least(lo + width - 1, F.col("hi")).alias("hi"),
    )


def shard_by_tree(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    `target_bytes` is the size of a leaf; `shards` sets it to that share of all
    bytes. Size is the UTF-8 bytes of the text plus 1. Null texts are empty, null
    metadata is a value of its own, documents that tie in every dimension are cut
    by a hash of id and text, and repeated rows each get a slot. Shards do not depend on
    how the table lies in files, but for rows of one id and text on two sides of a cut;
    slots do: they count from 0 in every shard without a gap, by partition. Other columns
    are not read; fewer documents than shards leave shards empty, an empty table gives no
    rows.
    """
    dims = metadata_dimensions()
    text = whole_text()
    row = F.monotonically_increasing_id()
    rows = docs.select(
        F.col(ID).cast("long").alias(ID),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftright(row, 33).alias("part"),
        tie_breaker(text, row).alias("tie"),
        *[c.alias(n) for n, c in dims.items()],
    )
    rows = materialize(rows, "points")
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, round(total / max(1, target_bytes or total or 1)))
    tree = rows.withColumn("first", F.lit(0)).withColumn("leaves", F.lit(shards))
    left = shards if total else 1
    while left > 1:
        tree, left = materialize(cut_level(tree, list(dims)), "level"), -(-left // 2)
    slots = W.partitionBy("first", "part").orderBy(ID, "tie")
    numbered = tree.withColumn("in_part", F.row_number().over(slots) - 1)
    parts = tree.groupBy("first", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("first").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("first", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["first", "part"]).select(
        ID,
        "size",
        "text_crc32",
        F.col("first").cast("int").alias("shard"),
        (F.col("in_part") + F.col("offset")).cast("long").alias("slot"),
    )

