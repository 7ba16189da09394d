from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import ngram


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def brute(docs, weights=None):
    """Scores from plain dictionaries; without given weights, by EM on the exact held-out ratios."""
    rest = [zlib.crc32(str(i).encode() if i is not None else b"") % 10 for i, _ in docs]
    texts = [tokens_of(t) for _, t in docs]

    def count(folds):
        uni, bi = Counter(), Counter()
        for r, w in zip(rest, texts):
            if r in folds:
                uni.update(w)
                bi.update(zip([None, *w], w))
        return uni, bi, sum(uni.values()), len(uni)

    def terms(w, uni, bi, n, v):
        for before, word in zip([None, *w], w):
            context = uni[before]
            bigram = bi[before, word] / max(1, context) * (v + 1)
            yield int(ngram.frequency(np.array([context]))[0]), bigram, uni[word] / max(1, n) * (v + 1)

    if weights is None:
        kept = count(range(2, 10))
        held = [t for r, w in zip(rest, texts) if r == 1 for t in terms(w, *kept)]
        weights = {f: exact_weights([t[1:] for t in held if t[0] == f] or [t[1:] for t in held]) for f in range(25)}
        weights[0] = (0.0, *(x / sum(weights[0][1:]) for x in weights[0][1:]))
    uni, bi, n, v = count(range(1, 10))
    out = []
    for r, w in zip(rest, texts):
        base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = 0.0
        for f, b, u in terms(w, uni, bi, n, v):
            x = weights[f]
            score += math.log10((x[0] * b + x[1] * u + x[2]) / (v + 1))
        out.append((r == 0, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def exact_weights(held):
    w = [1 / 3] * 3
    for _ in range(ngram.ROUNDS):
        shares = [[a * x for a, x in zip(w, (*t, 1.0))] for t in held]
        w = [sum(s[k] / sum(s) for s in shares) / len(held) for k in range(3)]
    return w


def run(spark, monkeypatch, docs, *extra):
    kept = {}
    learn = ngram.learn_weights
    monkeypatch.setattr(ngram, "learn_weights", lambda counts: kept.setdefault("w", learn(counts)))
    rows = ngram.score_documents(documents(spark, docs, *extra)).collect()
    return rows, kept["w"]


def compare(rows, expected, docs):
    found = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    assert found == sorted((repr(i), *e[:4], round(e[4], 6), round(e[5], 6)) for (i, _), e in zip(docs, expected))


def test_against_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(ngram, "BLOCK_BYTES", 3000)
    docs = [(i, words(i % 37, 30) + " The END " + words(i, 10)) for i in range(300)]
    rows, weights = run(spark, monkeypatch, docs, "'a' as tokens", "1 as fold")
    compare(rows, brute(docs, weights), docs)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_against_weights_learnt_by_dictionaries(spark):
    """The steps in which ratios are counted move a score by less than 0.2 %."""
    docs = [(i, " ".join([words(i % 23, 12), words(1000 + i, 6), words(i % 5, 9)])) for i in range(400)]
    rows = {r.doc_id: r.score for r in ngram.score_documents(documents(spark, docs)).collect()}
    for (i, _), expected in zip(docs, brute(docs)):
        assert abs(rows[i] - expected[-1]) < 0.002 * abs(expected[-1])


def test_odd_rows(spark, monkeypatch):
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)] * 2 + [(None, "one two")]
    rows, weights = run(spark, monkeypatch, docs)
    compare(rows, brute(docs, weights), docs)


def test_empty_and_untrained(spark, monkeypatch):
    assert ngram.score_documents(documents(spark, [])).collect() == []
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = ngram.score_documents(documents(spark, [(held, "a b")])).collect()
    assert (rows[0].n_tokens, rows[0].n_known, rows[0].train_tokens) == (3, 0, 0)
    assert all(math.isfinite(x) for x in (rows[0].base_score, rows[0].score))


def test_weights_follow_the_held_out_counts():
    import pandas as pd

    counts = pd.DataFrame({"f": [3, 3, 9], "b": [60, -(10**6), -(10**6)], "u": [10, 10, 40], "n": [90, 10, 50]})
    w = ngram.learn_weights(counts)
    assert w[3, 0] > 0.8 and w[9, 1] > 0.9 and w[9, 0] < 0.05
