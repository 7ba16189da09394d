from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import periodic


def brute(ids, least=24, periods=3):
    """All maximal runs, every lag and every stretch, smallest periods by trying all."""
    n, runs = len(ids), []
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and ids[i] == ids[i + q]:
                i += 1
            length = i - start + q
            if length < max(least, periods * q):
                continue
            own = ids[start : start + length]
            if not any(all(own[j] == own[j + p] for j in range(length - p)) for p in range(1, q)):
                runs.append((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def check(ids):
    ids = list(ids)
    assert periodic.find_runs(np.array(ids, dtype=np.int64)) == brute(ids), ids


def test_classes_cover_every_lag_once():
    found = list(periodic.lag_classes(9000))
    assert [c[1] for c in found[1:]] == [c[2] for c in found[:-1]] and found[0][1] == 1
    for gram, first, end in found:
        for q in range(first, end):
            assert max(24, 3 * q) - q >= gram and 3 * q < 2 * gram


def test_runs_against_every_lag():
    draw = random.Random(5)
    for case in range(400):
        kinds = draw.choice([1, 2, 2, 3, 50])
        ids = []
        for _ in range(draw.randint(1, 4)):
            ids += [draw.randrange(kinds) for _ in range(draw.randint(0, 30))]
            block = [draw.randrange(kinds) for _ in range(draw.randint(1, 45))]
            ids += (block * draw.randint(1, 9))[: draw.randint(1, 200)]
        check(ids)


def test_gram_that_recurs_inside_its_period():
    # every pair and triple of words recurs within one period, so near occurrences hide far ones
    blocks = ["00011101", "0001011100010111" "1", "aabaabaacaabaabaab", "0110100110010110" * 2 + "1"]
    for block in blocks:
        for times in (3, 4, 7):
            check([ord(c) for c in "xy" + block * times + block[:3] + "z"])
    long = [random.Random(1).randrange(3) for _ in range(20)]
    check((long + long[:18] + [7] + long + [8]) * 4)


def test_fibonacci_and_equal_words():
    a, b = "0", "01"
    while len(b) < 600:
        a, b = b, b + a
    check([int(c) for c in b])
    check([0] * 500)
    check([0] * 23)
    check([0] * 24)


def rewritten(doc_id, text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(found), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    found = rewritten(doc_id, text)
    runs = brute(found)
    kept = [all(not s + q <= i < s + size for s, size, q in runs) for i in range(len(found))]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listing = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listing, " ".join(w for w, k in zip(found, kept) if k))]
    top = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
    return (doc_id, len(runs), *top, *digest)


def digests(df):
    found = periodic.run_digests(periodic.periodic_runs(periodic.with_repeated_tail(df))).collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_documents_against_every_lag(spark):
    docs = []
    for i in range(150):
        draw = random.Random(i)
        passage = words(i, draw.randint(1, 30))
        docs.append((i, f"{words(i + 500, 20)}\n\t" + f"{passage} " * draw.randint(0, 6) + words(i + 900, draw.randint(0, 60))))
    found = digests(documents(spark, docs, "'a' as runs", "1 as h", "2 as n"))
    assert found == sorted((expected(*d) for d in docs), key=repr)
    planted = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 5 and sum(r[1] > 0 for r in found) > 40


def test_odd_rows(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = [(i, t) for ids in (range(len(ODD_TEXTS)), held) for i, t in zip(ids, [t for t in ODD_TEXTS if t is None or len(t) < 5000])]
    docs += [(None, "a b " * 40), (None, None), (7, "x " * 30), (7, "x " * 30), (-5, "é b " * 20)]
    assert digests(documents(spark, docs)) == sorted((expected(*d) for d in docs), key=repr)


def test_general_output(spark):
    rows = periodic.periodic_runs(documents(spark, ["go " * 10 + "and stop"]), least=6).collect()
    assert [tuple(r) for r in rows[0].runs] == [(0, 10, 1)] and rows[0].collapsed == "go and stop"
    with pytest.raises(ValueError):
        periodic.periodic_runs(documents(spark, []), periods=2)


def test_long_text(spark):
    text = " ".join(["tick"] * 60_000 + ["tock", "tack"] * 60_000 + words(1, 5000).split() * 3)
    row = periodic.periodic_runs(documents(spark, [text])).first()
    assert [tuple(r) for r in row.runs] == [(0, 60_000, 1), (60_000, 120_000, 2), (180_000, 15_000, 5000)]


def test_empty(spark):
    assert digests(documents(spark, [])) == []
