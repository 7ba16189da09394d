from __future__ import annotations

import math
from collections import Counter

import pytest
from helpers import documents
from parampipe.llm import mixing

SHARES = {"a": 5, "b": 2, "c": 1}


def simulate(blocks, shares):
    """Slot by slot: the earliest deadline among the released blocks."""
    order = []
    for phase in mixing.phases(blocks, shares):
        quotas, length = phase["quotas"], sum(phase["quotas"].values())
        done = dict.fromkeys(quotas, 0)
        for t in range(phase["cycles"] * length):
            ready = [
                (math.ceil((done[s] + 1) * length / q), i, s)
                for i, (s, q) in enumerate(quotas.items())
                if done[s] < phase["cycles"] * q and math.floor(done[s] * length / q) <= t
            ]
            source = min(ready)[2]
            order.append((source, phase["used"][source] + done[source]))
            done[source] += 1
    return order


def corpus(n):
    return [(i, f"t{i}", "abcd"[i % 7 % 4] if i % 5 else "a") for i in range(n)]


def test_against_a_simulation(spark):
    docs = corpus(900)
    rows = mixing.mix(documents(spark, docs, "1 as position", "2 as part"), SHARES, block=4).collect()
    assert len({r.position for r in rows}) == len(docs) == len({r.doc_id for r in rows})
    slots = sorted({(r.slot, r.part, r.block) for r in rows})
    blocks = Counter(part for _, part, _ in slots)
    assert [(p, b) for _, p, b in slots] == simulate(blocks, {**SHARES, mixing.OTHERS: 1})
    for r in rows:
        assert r.position == r.slot * 4 + r.ordinal % 4 and r.block == r.ordinal // 4


def test_deviation_stays_below_one_block():
    shares = {"a": 7, "b": 3, "c": 2, "d": 1}
    order = simulate({"a": 70, "b": 30, "c": 20, "d": 10}, shares)
    seen = Counter()
    for t, (source, _) in enumerate(order, 1):
        seen[source] += 1
        assert all(abs(seen[s] - t * w / 13) < 1 for s, w in shares.items())


def test_order_of_rows(spark):
    docs = documents(spark, corpus(300), "'k' as _key")
    out = mixing.in_mixed_order(docs, SHARES, block=4)
    assert out.columns == docs.columns
    place = {r.doc_id: r.position for r in mixing.mix(docs, SHARES, block=4).collect()}
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == 300 and [place[i] for i in ids] == sorted(place.values())


def test_odd_rows(spark):
    docs = [(1, None, None), (1, None, None), (None, "x", "a"), (None, "", "b"), (2, "y" * 9000, ""), (3, "z", "zz")]
    rows = mixing.mix(documents(spark, docs), SHARES, block=2).collect()
    assert len(rows) == 6 and len({r.position for r in rows}) == 6
    assert mixing.in_mixed_order(documents(spark, docs), SHARES).count() == 6
    assert mixing.mix(documents(spark, []), SHARES).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(documents(spark, docs), {"a": 0})
