from __future__ import annotations

import zlib

from helpers import ODD_TEXTS, documents, words
from parampipe.llm import kdtree
from parampipe.llm.common import whole_text
from pyspark.sql import functions as F


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def test_sizes_are_near_equal(spark):
    texts = [words(i, 5 + i % 90) for i in range(1500)] + ["the very same text"] * 700
    rows = kdtree.shard_by_tree(documents(spark, texts, "'a' as shard", "1 as first"), shards=8).collect()
    sizes = check(rows, texts, 8)
    assert max(sizes) - min(sizes) <= 3 * 1000


def test_uneven_number_of_leaves(spark):
    texts = [words(i, 20) for i in range(900)]
    sizes = check(kdtree.shard_by_tree(documents(spark, texts), shards=5).collect(), texts, 5)
    assert max(sizes) < 1.05 * min(sizes)


def test_target_bytes(spark):
    texts = [words(i, 20) for i in range(300)]
    total = sum(len(t) + 1 for t in texts)
    rows = kdtree.shard_by_tree(documents(spark, texts), target_bytes=total // 3).collect()
    assert {r.shard for r in rows} == {0, 1, 2}


def test_cut_lies_in_the_widest_dimension(spark):
    docs = [(i, "x" * 50, "src1" if i < 40 else "src2") for i in range(80)]
    rows = kdtree.shard_by_tree(documents(spark, docs), shards=2).collect()
    assert len({r.shard for r in rows if r.doc_id < 40}) == 1 and len({r.shard for r in rows if r.doc_id >= 40}) == 1


def plain_tree(rows, dims, leaves):
    """Shard of every row (name, size, tie, coordinates) by recursive cuts of sorted lists."""
    extent = [max(1, max(r[3][d] for r in rows) - min(r[3][d] for r in rows)) for d in range(dims)]
    shards = {}

    def cut(own, first, leaves):
        if leaves == 1 or not own:
            shards.update({r[0]: first for r in own})
            return
        wide = [(max(r[3][d] for r in own) - min(r[3][d] for r in own)) / extent[d] for d in range(dims)]
        d = wide.index(max(wide))
        own = sorted(own, key=lambda r: (r[3][d], r[2]))
        goal, total, n = sum(r[1] for r in own) * (leaves // 2) // leaves, 0, 0
        while n < len(own) and total < goal:
            total, n = total + own[n][1], n + 1
        cut(own[:n], first, leaves // 2)
        cut(own[n:], first + leaves // 2, leaves - leaves // 2)

    cut(rows, 0, leaves)
    return shards


def test_against_a_plain_tree_and_in_any_layout(spark):
    docs = [(i, words(i, 3 + i % 40) if i % 3 else "the very same text", f"s{i % 7 % 4}") for i in range(600)]
    df = documents(spark, docs)
    names = kdtree.metadata_dimensions()
    seen = df.select(
        "doc_id",
        (F.octet_length(whole_text()) + 1).alias("size"),
        kdtree.tie_breaker(whole_text(), F.lit(0)).alias("tie"),
        F.array(*names.values()).alias("x"),
    ).collect()
    for shards, parts in ((5, 3), (8, 3), (8, 5)):
        want = plain_tree([(r.doc_id, r.size, r.tie, r.x) for r in seen], len(names), shards)
        found = kdtree.shard_by_tree(df.repartition(parts), shards=shards).collect()
        assert {r.doc_id: r.shard for r in found} == want


def test_rows_of_one_id_are_cut_too(spark):
    rows = kdtree.shard_by_tree(documents(spark, [(7, "the same", "s")] * 4000), shards=4).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(4)]
    assert sum(sizes) == 4000 and max(sizes) - min(sizes) < 40


def test_odd_rows(spark):
    docs = [(i, t, None if i % 2 else "s") for i, t in enumerate(ODD_TEXTS)] * 3 + [(None, "x", None)] * 4
    rows = kdtree.shard_by_tree(documents(spark, docs), shards=8).collect()
    assert len(rows) == len(docs)
    assert len({(r.shard, r.slot) for r in rows}) == len(docs)
    assert kdtree.shard_by_tree(documents(spark, []), shards=8).collect() == []
    assert len(kdtree.shard_by_tree(documents(spark, ["one"]), shards=8).collect()) == 1
