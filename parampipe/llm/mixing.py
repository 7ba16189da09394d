"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks. With weight w, block i of a source may not run
before slot floor(i / w) and must run before slot ceil((i + 1) / w); the earliest
deadline among the released blocks goes first. As the weights are whole shares of
a cycle, the schedule repeats with the cycle, so one cycle is worked out and every
block's slot follows by arithmetic. Functions of Spark SQL only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.llm.common import ID, fresh, materialize, text_hash
from parampipe.operators.numbering import with_ordinal

# Documents of a block.
BLOCK = 16
# Name of the sources that have no share of their own.
OTHERS = ""


def edf_order(quotas: Column) -> Column:
    """Index of the source that runs in each slot of a cycle of sum(quotas) slots.

    One fold over the slots. `quotas` is an array of blocks per source.
    """
    length = F.aggregate(quotas, F.lit(0), lambda a, q: a + q)
    idle = F.transform(quotas, lambda q: F.lit(0))

    def slot(state: Column, t: Column) -> Column:
        def window(q: Column, j: Column) -> Column:
            done = F.element_at(state["done"], j + 1)
            release = F.floor(done * length / q)
            deadline = F.ceil((done + 1) * length / q)
            ready = (done < q) & (release <= t)
            return F.when(ready, F.struct(deadline.alias("deadline"), j.alias("source")))

        first = F.array_min(F.array_compact(F.transform(quotas, window)))["source"]
        return F.struct(
            F.transform(state["done"], lambda d, j: d + F.when(j == first, 1).otherwise(0)).alias("done"),
            F.concat(state["order"], F.array(first)).alias("order"),
        )

    start = F.struct(idle.alias("done"), F.array().cast("array<int>").alias("order"))
    slots = F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(slots, start, slot, lambda state: state["order"])


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[dict]:
    """Runs of equal cycles: first slot, number of cycles, and blocks per source and cycle.

    While all sources last, a cycle holds every source's shares. The source that
    ends first has its rest in one shorter cycle; then the others go on with the
    weights they have among themselves.
    """
    left, used, first, found = dict(blocks), dict.fromkeys(blocks, 0), 0, []

    def add(cycles: int, quotas: dict[str, int]) -> None:
        nonlocal first
        if cycles and any(quotas.values()):
            found.append({"first": first, "cycles": cycles, "quotas": quotas, "used": dict(used)})
            first += cycles * sum(quotas.values())
            for source, quota in quotas.items():
                left[source] -= cycles * quota
                used[source] += cycles * quota

    while active := [s for s in sorted(left) if left[s] > 0]:
        add(min(left[s] // shares[s] for s in active), {s: shares[s] for s in active})
        active = [s for s in active if left[s] > 0]
        if any(left[s] < shares[s] for s in active):
            add(1, {s: min(left[s], shares[s]) for s in active})
    return found


def slot_table(spark: SparkSession, blocks: dict[str, int], shares: dict[str, int]) -> DataFrame:
    """Columns (source, used, cycles, quota, place, offset, first, length): where a cycle
    puts the `place`-th block of a source, for every phase.

    At most 2 * sources phases of sum(shares) slots: bounded by the parameter.
    """
    rows = [
        (p["first"], p["cycles"], list(p["quotas"]), list(p["quotas"].values()), [p["used"][s] for s in p["quotas"]])
        for p in phases(blocks, shares)
    ]
    schema = "first long, cycles long, names array<string>, quotas array<int>, used_by array<long>"
    cycles = spark.createDataFrame(rows, schema).withColumn("length", F.expr("cast(aggregate(quotas, 0, (a, q) -> a + q) as long)"))
    slots = cycles.select("*", F.posexplode(edf_order(F.col("quotas"))).alias("offset", "j"))
    # the place of a slot among those of its source in the cycle
    order = slots.groupBy("first", "cycles", "names", "quotas", "used_by", "length", "j").agg(
        F.array_sort(F.collect_list("offset")).alias("offsets")
    )
    return order.select(
        F.element_at("names", F.col("j") + 1).alias("source"),
        F.element_at("used_by", F.col("j") + 1).alias("used"),
        "cycles",
        F.element_at("quotas", F.col("j") + 1).cast("long").alias("quota"),
        "first",
        "length",
        F.posexplode("offsets").alias("place", "offset"),
    )


def mix(docs: DataFrame, shares: dict[str, int], others: int = 1, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, text_hash, source, part (the name its share goes by), ordinal, block, slot, position.

    `shares` gives whole shares of a cycle by source; all sources without one, the
    null source among them, share `others` under one name. Within its part a document
    comes by doc_id (null first), text hash and source. Until the first part ends, every
    prefix of slots holds each part's weight to within less than one block; every
    document has a position, none is dropped or repeated. Repeated rows follow one
    another. Null texts are empty; an empty table gives no rows.
    """
    if not all(int(s) == s and s > 0 for s in [*shares.values(), others]):
        raise ValueError("shares are whole numbers above 0")
    spark = docs.sparkSession
    named = F.col("source").isin(*shares) if shares else F.lit(False)
    rows = docs.select(
        F.col(ID).cast("long").alias(ID),
        text_hash().alias("text_hash"),
        F.col("source").cast("string").alias("source"),
    ).withColumn("part", F.when(named, F.col("source")).otherwise(F.lit(OTHERS)))
    order = [F.col(ID), F.col("text_hash"), F.col("source")]
    placed = with_ordinal(rows, order, "ordinal", ["part"])
    placed = materialize(placed.withColumn("ordinal", F.col("ordinal") - 1), "ordinals")
    placed = placed.withColumn("block", F.expr(f"ordinal div {block}"))
    # one count for each share
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg((F.max("block") + 1).alias("n")).collect()}
    slots = slot_table(spark, counts, {**shares, OTHERS: others}).withColumnRenamed("source", "of_part")
    slots = materialize(slots, "slots")
    parts = slots.select("of_part", "used", "cycles", "quota", "first", "length").distinct()
    inside = F.col("block").between(F.col("used"), F.col("used") + F.col("cycles") * F.col("quota") - 1)
    # both tables hold a row for a share and phase, or for a slot of one cycle of it
    run = placed.join(F.broadcast(parts), (F.col("part") == F.col("of_part")) & inside).drop("of_part")
    run = run.withColumn("place", ((F.col("block") - F.col("used")) % F.col("quota")).cast("int"))
    run = run.withColumn("cycle", F.expr("(block - used) div quota"))
    at = F.broadcast(slots.select("of_part", F.col("first").alias("of_first"), F.col("place").alias("of_place"), "offset"))
    on = (F.col("part") == F.col("of_part")) & (F.col("first") == F.col("of_first")) & (F.col("place") == F.col("of_place"))
    slot = F.col("first") + F.col("cycle") * F.col("length") + F.col("offset")
    return run.join(at, on).select(
        ID,
        "text_hash",
        "source",
        "part",
        "ordinal",
        "block",
        slot.alias("slot"),
        (slot * block + F.col("ordinal") % block).alias("position"),
    )


def with_position(docs: DataFrame, shares: dict[str, int], others: int = 1, block: int = BLOCK, name: str = "position") -> DataFrame:
    """The rows of `docs` with their place in the mix as the column `name` (which must be free).

    Repeated rows (equal id, text and source) all get the first of their positions.
    """
    key, mark, source, hashed = (fresh(docs, n) for n in ("_key", "_mark", "_name", "_hash"))
    first = mix(docs, shares, others, block).groupBy(ID, "text_hash", "source").agg(F.min("position").alias(name))
    first = first.select(F.col(ID).alias(key), F.col("text_hash").alias(mark), F.col("source").alias(source), name)
    rows = docs.withColumn(hashed, text_hash())
    on = (
        rows[ID].cast("long").eqNullSafe(first[key])
        & (rows[hashed] == first[mark])
        & rows["source"].cast("string").eqNullSafe(first[source])
    )
    return rows.join(first, on).select(*docs.columns, name)


def in_mixed_order(docs: DataFrame, shares: dict[str, int], others: int = 1, block: int = BLOCK) -> DataFrame:
    """The rows of `docs` in the order of the mix, with all their columns.

    Files written from the result follow one another in that order. Repeated rows
    (equal id, text and source) lie together at the first of their positions.
    """
    at = fresh(docs, "_position")
    ordered = with_position(docs, shares, others, block, at).repartitionByRange(at).sortWithinPartitions(at)
    return ordered.select(*docs.columns)
