from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
BAD = ["rotgut", "scumbag", "vileness", "wretchy"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def labels(spark, rows):
    return spark.createDataFrame([(i, 1, y) for i, y in rows], LABELS)


def corpus(n=400):
    docs, marks = [], []
    for i in range(n):
        draw, toxic = random.Random(i), int(i % 5 == 0)
        own = words(i, draw.randint(20, 60)).split()
        for _ in range(3 * toxic):
            own.insert(draw.randrange(len(own)), draw.choice(BAD))
        docs.append((i, " ".join(own)))
        marks.append((i, toxic))
    return docs, marks


def plain_grams(text):
    text = f" {' '.join((text or '').lower().split())} "
    return [text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)]


def test_grams_are_those_of_the_text():
    for text in [*(t for t in ODD_TEXTS if t), "Ärger Über\n\tETWAS", words(1, 300)]:
        plain, found = Counter(plain_grams(text)), toxicity.grams(text, 40)
        assert sorted(plain.values()) == sorted(Counter(found.tolist()).values())
    assert len(toxicity.grams("")) == 0 and toxicity.grams("ab").size == 1
    own, times = toxicity.counted(np.array([4] * 50 + [2]))
    assert own.tolist() == [2, 4] and times.tolist() == [1, toxicity.MOST_COUNT]


def test_counts_are_over_all_documents(spark):
    docs, marks = corpus(60)
    label = dict(marks)
    rows = spark.createDataFrame([(t, label[i], i, i < 7) for i, t in docs], "text string, label int, h long, sampled boolean")
    parts = toxicity.count_parts(rows.repartition(4)).collect()
    found = {}
    for r in parts:
        if r.bucket is not None:
            a, b = found.get(r.bucket, (0, 0))
            found[r.bucket] = (a + r.toxic, b + r.other)
    expected = {-1: (12, 48)}
    for i, t in docs:
        for b in set(toxicity.grams(t).tolist()):
            a, o = expected.get(b, (0, 0))
            expected[b] = (a + label[i], o + 1 - label[i])
    assert found == expected
    assert sorted((r.h, r.text) for r in parts if r.text is not None) == sorted(docs[:7])


def test_ratios_against_the_formula():
    toxic, other = np.array([0, 9, 3, 0]), np.array([30, 1, 3, 2])
    found = toxicity.log_ratios(toxic, other)
    p, q = [1, 10, 4, 1], [31, 2, 4, 3]
    expected = [np.log(a / sum(p) / (b / sum(q))) for a, b in zip(p, q)]
    keep = [t + o >= 5 and abs(r) >= 1.2 for t, o, r in zip(toxic, other, expected)]
    assert np.allclose(found, np.where(keep, expected, 0)) and keep == [True, True, False, False]


def test_score_is_the_sum_of_its_features(spark):
    values = np.zeros(1 << 12)
    draw = random.Random(3)
    for k in range(0, 1 << 12, 3):
        values[k] = np.float32(draw.uniform(-0.05, 0.05))
    model = toxicity.Model(values, -0.3)
    texts = [t for t in ODD_TEXTS if t] + [words(i, 40) for i in range(5)]
    rows = toxicity.score_documents(documents(spark, texts), model).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        times = Counter(toxicity.grams(t, 12).tolist())
        z = -0.3 + sum(values[b] * min(k, toxicity.MOST_COUNT) for b, k in times.items())
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert r.predicted == int(r.score >= 0.7)


def test_held_out_documents_are_told_apart(spark):
    docs, marks = corpus()
    df = documents(spark, docs)
    rows = toxicity.score_documents(df, toxicity.fit(df, labels(spark, marks))).collect()
    assert all(r.held_out == held(r.doc_id) for r in rows)
    own = [r for r in rows if r.held_out]
    label = dict(marks)
    assert len(own) > 100
    caught = [r.predicted for r in own if label[r.doc_id]]
    wrong = [r.predicted for r in own if not label[r.doc_id]]
    assert np.mean(caught) > 0.9 and sum(wrong) == 0


def test_held_out_labels_and_other_columns_are_not_read(spark):
    docs, marks = corpus(150)
    a = toxicity.fit(documents(spark, docs), labels(spark, marks))
    turned = [(i, 1 - y if held(i) else y) for i, y in marks]
    other = documents(spark, [(i, t, "elsewhere") for i, t in docs], "'x' as label", "1 as h", "2 as sampled")
    b = toxicity.fit(other, labels(spark, [*turned, (None, 1), (9999, 1), (3, None)]))
    assert a.bias == b.bias and (a.values == b.values).all()


def test_sample_is_bounded_and_counts_are_not(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 20)
    monkeypatch.setattr(toxicity, "SAMPLE_OTHER", 30)
    seen = {}
    fit_weights = toxicity.fit_weights
    monkeypatch.setattr(toxicity, "fit_weights", lambda f, r, d: seen.setdefault("m", (f, r, d)) and fit_weights(f, r, d))
    docs, marks = corpus(300)
    toxicity.fit(documents(spark, [*docs, *docs[:40]]), labels(spark, marks))
    features, _, counted = seen["m"]
    label = dict(marks)
    rows = [i for i, _ in [*docs, *docs[:40]] if not held(i)]
    assert len(features) <= 50 and counted == (sum(label[i] for i in rows), sum(1 - label[i] for i in rows))


def test_odd_rows(spark):
    docs, marks = corpus(60)
    odd = [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, BAD[0]), (None, None), (0, docs[0][1]), (0, docs[0][1])]
    df = documents(spark, [*docs, *odd], "'s' as score", "'h' as held_out", "3 as toxic")
    rows = toxicity.score_documents(df, toxicity.fit(df, labels(spark, [*marks, (1000, 1), (1001, 0), (0, 0)])))
    assert rows.columns == [*df.columns, "_held_out", "_score", "predicted"]
    found = rows.collect()
    assert len(found) == len(docs) + len(odd) and all(0 <= r["_score"] <= 1 for r in found)
    assert len({r["_score"] for r in found if r.doc_id in (1000, 1001, 1002)}) == 1
    assert not any(r["_held_out"] for r in found if r.doc_id is None)


@pytest.mark.parametrize("marks", [[], [(i, 0) for i in range(30)], [(i, 1) for i in range(30)]])
def test_labels_of_one_kind(spark, marks):
    df = documents(spark, corpus(30)[0])
    rows = toxicity.score_documents(df, toxicity.fit(df, labels(spark, marks))).collect()
    score = {r.score for r in rows}
    assert len(score) == 1 and 0 < score.pop() < 1


def test_empty(spark):
    df = documents(spark, [])
    assert toxicity.score_documents(df, toxicity.fit(df, labels(spark, [(1, 1)]))).collect() == []


def test_held_out_labels_of_the_test_tables(spark):
    """Held-out accuracy on generated documents in four languages."""
    folder = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_documents(docs, toxicity.fit(docs, marks)).join(marks, "doc_id").where("held_out")
    caught, missed, wrong, right = (
        rows.where(f"predicted = {p} and toxic = {y}").count() for p, y in ((1, 1), (0, 1), (1, 0), (0, 0))
    )
    assert caught / (caught + missed) > 0.7 and wrong / (wrong + right) < 0.01
