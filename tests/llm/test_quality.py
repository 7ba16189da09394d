from __future__ import annotations

import itertools
import random
import re

import numpy as np
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import quality


def plain_counts(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts():
    samples = ["", "a b c a b c", "a\na\n\n \n a", words(1, 80) + "\n" + words(1, 80), "é# 漢|字\x1f \x85x y", "one two"]
    for text in samples:
        assert quality.judge(text, quality.no_boilerplate())[:5] == plain_counts(text)


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        scores, steps, start = draw.normal(size=(n, 2)), draw.normal(size=(2, 2)), draw.normal(size=2)

        def total(path):
            return start[path[0]] + sum(scores[i, p] for i, p in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert tuple(quality.viterbi(scores, steps, start)) == best


def test_expectations_against_all_paths():
    draw = np.random.default_rng(2)
    x, weights = draw.normal(size=(1, 4, quality.FEATURES)), draw.normal(size=(quality.FEATURES, 2))
    steps, start = draw.normal(size=(2, 2)), draw.normal(size=2)
    live = np.array([[True, True, True, False]])
    paths, scores = list(itertools.product((0, 1), repeat=3)), x[0] @ weights
    mass = np.array([
        np.exp(start[p[0]] + sum(scores[i, k] for i, k in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:])))
        for p in paths
    ])
    mass /= mass.sum()
    moves, first = np.zeros((2, 2)), np.zeros(2)
    for p, m in zip(paths, mass):
        first[p[0]] += m
        for a, b in zip(p, p[1:]):
            moves[a, b] += m
    found = quality._expectations(x, live, live[:, 1:] & live[:, :-1], weights, steps, start)
    assert np.allclose(found[1], moves) and np.allclose(found[2], first)


def junk(seed):
    draw = random.Random(seed)
    return "\n".join(" ".join(w + draw.choice(["***", "$$$", "###"]) for w in words(seed * 9 + k, 20).split()) for k in range(4))


def prose(seed):
    return "\n".join(words(seed * 9 + k, 20).capitalize() + "." for k in range(4))


def test_learnt_model_on_unseen_documents(spark):
    docs = documents(spark, [(i, junk(i) if i % 4 == 0 else prose(i)) for i in range(160)], "1 as kept")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(80)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_on_sample(docs, labels)
    found = {r.doc_id: r.kept for r in quality.judge_documents(docs, model).collect()}
    assert found == {i: i % 4 != 0 for i in range(160)}
    left = quality.keep_good(docs, model)
    assert left.columns == docs.columns and left.count() == 120


def mixed(seed, lines, bad):
    """Prose with `bad` junk lines in a row, and the labels of its lines."""
    draw = random.Random(seed)
    at = draw.randrange(lines - bad + 1)
    kinds = [int(at <= i < at + bad) for i in range(lines)]
    source = [junk(seed * 50 + i).split("\n")[0] if k else prose(seed * 50 + i).split("\n")[0] for i, k in enumerate(kinds)]
    return "\n".join(source), kinds


def test_lines_are_labelled_inside_documents(spark):
    # good documents of 10 lines hold 0 to 3 junk lines, bad ones 7 to 10
    texts = [mixed(i, 10, (i % 4) + (7 if i % 3 == 0 else 0)) for i in range(90)]
    quality_of = [int(i % 3 != 0) for i in range(90)]
    docs = documents(spark, [(i, t) for i, (t, _k) in enumerate(texts)])
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(quality_of)], "doc_id long, quality int, toxic int")
    model = quality.fit_on_sample(docs, labels)
    unseen = [mixed(1000 + i, 20, bad) for i, bad in enumerate([0, 2, 5, 8, 9, 11, 12, 15, 20])]
    right = total = 0
    for text, kinds in unseen:
        path = quality.viterbi(quality.line_features(text.encode().split(b"\n")) @ model.weights, model.steps, model.start)
        right, total = right + int((path == np.array(kinds)).sum()), total + len(kinds)
        share = quality.judge(text, model)[6]
        assert 0 < share < 1 or sum(kinds) in (0, 20)
        # the share counts characters, and junk words are longer
        sizes = np.array([len("".join(line.split())) for line in text.split("\n")])
        truth = sizes[np.array(kinds) == 0].sum() / sizes.sum()
        assert abs(share - truth) < 0.06
        assert quality.judge(text, model)[7] == (share >= 0.5)
    assert right >= 0.97 * total


def test_relabelled_lines_leave_the_document_its_label():
    weights = np.zeros((quality.FEATURES, 2))
    weights[2, quality.BOILERPLATE] = 10.0
    weights[0, quality.BOILERPLATE] = -1.0
    model = quality.Model(weights, np.zeros((2, 2)), np.zeros(2))
    rows = np.zeros((5, quality.FEATURES))
    rows[:, 0], rows[:, 2] = 1.0, [0.9, 0.0, 0.8, 0.3, 0.0]
    # three lines look like boilerplate; two may go in a document that is content
    assert quality.relabel(rows, quality.CONTENT, model).tolist() == [1, 0, 1, 0, 0]
    assert quality.relabel(rows, quality.BOILERPLATE, model).tolist() == [1, 0, 1, 1, 0]
    assert quality.relabel(rows[:1], quality.CONTENT, model).tolist() == [0]
    assert quality.relabel(rows[:0], quality.CONTENT, model).tolist() == []


def test_sampled_lines_are_neighbours():
    text = "\n".join(words(i, 3) + "#" * i for i in range(200)).encode()
    rows = quality.sample_lines(text)
    whole = quality.line_features(text.split(b"\n"))
    starts = [i for i in range(len(whole)) if np.array_equal(whole[i : i + len(rows)], rows)]
    assert len(rows) == quality.SAMPLE_LINES and len(starts) == 1


def test_odd_rows_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, prose(1)), (None, prose(1))])
    model = quality.fit_on_sample(docs, labels)
    rows = quality.judge_documents(docs, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    assert [r.kept for r in rows if r.doc_id is None] == [True, True]
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id is not None)
    assert quality.judge_documents(docs.limit(0), model).collect() == []
