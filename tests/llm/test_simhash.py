from __future__ import annotations

import random

import numpy as np
import xxhash
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import simhash


def plain_fingerprint(text):
    import re

    tokens = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not tokens:
        return 0
    grams = [b" ".join(tokens[i : i + 4]) for i in range(max(1, len(tokens) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(values))]


def test_fingerprint_is_the_native_hash(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("a b c d",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42) == simhash.fingerprint("A b C\td")
    for text in [words(1, 3), words(2, 200), "É e x", *[t for t in ODD_TEXTS if t]]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_tile_forest_spans_all_links():
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(20)]
    near = [b ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for b in base * 20]
    values = sorted(set(base + near))
    packed = np.array(values, dtype=np.uint64).view(np.int64)
    links = simhash.tile_forest(packed, packed, True, 4)
    assert len(links) < len(values)
    at = {v: i for i, v in enumerate(packed.tolist())}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert (values[at[a]] ^ values[at[b]]).bit_count() <= 4
        root[max(find(at[a]), find(at[b]))] = min(find(at[a]), find(at[b]))
    assert [find(i) for i in range(len(values))] == components(values, 4)


def near_copies():
    docs = [words(s, 120) for s in range(40)]
    for s in range(40):
        w = docs[s].split()
        w[s] = "other"
        docs += [" ".join(w), docs[s], docs[s].upper()]
    return docs


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    docs = near_copies() + [t for t in ODD_TEXTS]
    values = [simhash.fingerprint(t or "") for t in docs]
    found = simhash.near_duplicates(documents(spark, docs, "1 as fp", "2 as component")).collect()
    assert len(found) == len(docs)
    expected = components(values, 4)
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in found} == {
        i: (v, c) for i, (v, c) in enumerate(zip(values, expected))
    }


def test_one_of_each_group_stays(spark):
    docs = [(9, words(1, 80)), (4, words(1, 80)), (4, words(1, 80)), (7, words(2, 80)), (None, words(2, 80)),
            (None, words(3, 80)), (None, words(3, 80)), (2, None), (3, "")]
    df = documents(spark, docs, "'z' as _key")
    out = simhash.keep_one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 2), (False, 4), (False, 7), (True, 0)]


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.keep_one_of_each(documents(spark, [])).collect() == []
