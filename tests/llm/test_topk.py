from __future__ import annotations

import math
import random

from parampipe.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score int"


def brute(rows, every, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * x) for x in v]
    out = set()
    for q, a in usable.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def run(spark, rows, every=50, k=5):
    df = spark.createDataFrame([(i, v, 0, "a", 1) for i, v in rows], SCHEMA)
    return {tuple(r) for r in topk.top_k(df, every, k).collect()}


def vectors(n, dims, seed=3):
    import struct

    draw = random.Random(seed)
    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    centres = [[draw.gauss(0, 0.1) for _ in range(dims)] for _ in range(8)]
    return [(i, [single(c + draw.gauss(0, 0.05)) for c in draw.choice(centres)]) for i in range(n)]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rows = vectors(700, 16)
    assert run(spark, rows, 20) == brute(rows, 20, 5)


def test_ties_take_the_smaller_id(spark):
    rows = [(i, [0.5, 0.25]) for i in range(12)] + [(i, [-0.5, 0.0]) for i in range(12, 20)]
    assert run(spark, rows, 5) == brute(rows, 5, 5)


def test_search_stops_on_proof_before_the_end():
    import numpy as np

    rows = vectors(2000, 8)
    data = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    built = topk.Block(type("Row", (), topk.build_block(0, np.arange(2000), data)))
    rescored = [len(built.possible(data[q], np.arange(2000) != q, 5)) for q in range(0, 2000, 100)]
    assert max(rescored) < 2000 and sum(rescored) < 20 * 2000 // 4


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]), (None, [1.0, 1.0]),
            (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0]), (-50, []), (9, [3.0e9, 1.0])]
    assert run(spark, rows) == brute(rows, 50, 5)


def test_few_and_no_rows(spark):
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0])]) == set()
