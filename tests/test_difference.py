"""Differences of deliveries against plain multisets; removal of versions."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from parampipe.operators import difference as D
from parampipe.operators import sinks as S
from parampipe.session import plan_text

SCHEMA = "k long, part string, v double"


def plain(old, new):
    a, b = collections.Counter(old), collections.Counter(new)
    rows = [(r, D.NEW, (b - a)[r]) for r in b - a] + [(r, D.OLD, (a - b)[r]) for r in a - b]
    sides = collections.defaultdict(set)
    for r, side, _n in rows:
        sides[r[0]].add(side)
    name = {D.NEW: D.ADDED, D.OLD: D.REMOVED}
    return sorted((D.CHANGED if len(sides[r[0]]) > 1 else name[s], s, n, repr(r)) for r, s, n in rows)


def found(df):
    return sorted((r.change, r.side, r.times, repr((r.k, r.part, r.v))) for r in df.collect())


def deliveries(seed, n=400):
    draw = random.Random(seed)
    rows = [
        (draw.choice([None, *range(n)]), draw.choice([None, "a", "b"]), draw.choice([None, 0.5, 1.5]))
        for _ in range(n)
    ]
    # a third of the rows has one key
    rows += [(7, "hot", float(i % 40)) for i in range(n // 2)]
    other = [r for r in rows if draw.random() > 0.05] + [(draw.randrange(2 * n), None, 9.5) for _ in range(20)]
    other += [(r[0], r[1], 2.5) for r in rows if draw.random() < 0.05]
    return rows, draw.sample(other, len(other))


@pytest.mark.parametrize("bits, most", [(0, 100), (5, 100), (17, 100), (17, 3)])
def test_against_multisets(spark, bits, most):
    rows, other = deliveries(bits)
    old, new = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (rows, other))
    kept = D.digests(old, ["k"], bits)
    assert found(D.part_difference(old, new.select("v", "k", "part"), ["k"], kept, most)) == plain(rows, other)
    nodes, level = D.differing_nodes(kept, D.digests(new, ["k"], bits), most)
    assert nodes.count() <= most and level <= bits and (most > 3 or level == 0)


def test_only_differing_buckets_are_compared(spark):
    old = spark.range(20_000).selectExpr("id as k", "cast(id as string) as v")
    new = old.where("k <> 5").unionByName(spark.createDataFrame([(123, "again")], old.schema))
    before, after = (D.digests(d, ["k"], 16) for d in (old, new))
    nodes, level = D.differing_nodes(before, after)
    assert level == 16 and nodes.count() == 2
    left = D.rows_below(old, nodes, level, ["k"])
    assert left.count() < 20 and "BroadcastHashJoin" in plan_text(left) and "Exchange hash" not in plan_text(left)
    rows = {(r.change, r.side, r.k) for r in D.part_difference(old, new, ["k"], before).collect()}
    assert rows == {("removed", "old", 5), ("added", "new", 123)}


def test_digests_add_up(spark):
    rows = spark.range(3000).selectExpr("id as k", "id % 7 as v")
    parts = [D.digests(rows.where(c), ["k"], 6) for c in ("v < 3", "v >= 3")]
    nodes, level = D.differing_nodes(D.merge(*parts), D.digests(rows.repartition(5), ["k"], 6))
    assert nodes.isEmpty() and level == 0
    with pytest.raises(ValueError):
        D.merge(parts[0], D.digests(rows, ["k"], 5))


def test_equal_empty_and_odd_deliveries(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "x", float("nan")), (None, "x", float("nan"))], SCHEMA)
    empty = rows.limit(0)
    assert D.part_difference(rows, rows.orderBy("part"), ["k"]).isEmpty()
    assert D.part_difference(empty, empty, ["k"]).isEmpty()
    assert [r.times for r in D.part_difference(empty, rows, ["k"]).orderBy("times").collect()] == [1, 2]
    # a column that cannot be NULL on one side only
    sure = spark.range(3).selectExpr("id as k", "'a' as part", "1D as v")
    assert D.part_difference(sure, spark.createDataFrame(sure.collect(), SCHEMA), ["k"]).isEmpty()
    for bad in (rows.drop("v"), rows.withColumn("v", F.col("v").cast("string")), rows.withColumn("side", F.lit(1))):
        with pytest.raises(ValueError):
            D.part_difference(rows if "side" not in bad.columns else bad, bad, ["k"])


def test_version_folders_go(spark, tmp_path):
    path = str(tmp_path / "v")
    assert S.remove_versions(spark, path) == []
    for n in range(12):
        S.write_version(spark.range(n + 1), path, f"v {n:02d}")
    assert S.remove_versions(spark, path) == ["v 00", "v 01"]
    assert S.remove_versions(spark, path) == []
    assert len([f for f in (tmp_path / "v").iterdir() if f.name.startswith("version=")]) == 10
    left = S.read_versions(spark, path, spark.range(1).schema, keep=100)
    assert left.groupBy("version").count().count() == 10 and left.count() == sum(range(3, 13))
    with pytest.raises(ValueError):
        S.remove_versions(spark, path, 0)
