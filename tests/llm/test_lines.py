from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import lines


def shingles(line):
    raw = line.encode("utf-16-be")
    n = 5
    return {raw[2 * i : 2 * i + 2 * n] for i in range(max(1, len(raw) // 2 - n + 1))}


def blank(line):
    return not line.strip(" \t\x0b\x0c\r")


def brute(docs):
    """Kept positions by document, over components of all pairs."""
    places, order = {}, sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    for i, text in order:
        for pos, line in enumerate((text or "").split("\n")):
            if not blank(line):
                places.setdefault(line, (i is None, i or 0, pos, i))
    items = list(places)
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingles(x) for x in items]
    for a in range(len(items)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best = {}
    for k, line in enumerate(items):
        best[find(k)] = min(best.get(find(k), (True, float("inf"), 0, None)), places[line])
    kept = {}
    for _, _, pos, i in best.values():
        kept.setdefault(i, set()).add(pos)
    return {
        i: "\n".join(
            x for p, x in enumerate((text or "").split("\n")) if blank(x) or p in kept.get(i, ())
        )
        for i, text in docs
    }


def edited(line, seed, n):
    draw, out = random.Random(seed), line.split()
    for _ in range(n):
        out[draw.randrange(len(out))] = "changed%d" % draw.randrange(100)
    return " ".join(out)


def test_against_all_pairs(spark):
    base = [words(s, 30 + s) for s in range(20)]
    docs = []
    for i in range(60):
        draw = random.Random(i)
        own = [edited(draw.choice(base), 100 * i + j, draw.choice([0, 0, 1, 9])) for j in range(4)]
        docs.append((i, "\n".join([*own, "", "the same line in all of them", words(1000 + i, 15)])))
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == brute(docs)


def test_transitive_and_first_occurrence(spark):
    a = words(1, 60)
    b = edited(a, 1, 2)
    docs = [(5, a), (3, f"{b}\n{b}\n\n{a}"), (9, "short\nshort")]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == brute(docs) == {5: "", 3: f"{b}\n", 9: "short"}


def test_signature_is_the_least_of_the_line_alone():
    """A line's keys do not depend on the lines hashed with it, and similar lines share some."""
    own = [words(s, 3 + 40 * (s % 5)) for s in range(40)] + ["exact", "\ud83d\ude00 " * 9, words(9, 30_000)]
    together = lines.band_keys(own)
    assert all((lines.band_keys([x])[0] == k).all() for x, k in zip(own, together))
    a = words(50, 60)
    pair = lines.band_keys([a, a.replace("e", "x", 1), words(51, 60)])
    assert (pair[0] == pair[1]).any() and not (pair[0] == pair[2]).any()


def test_share_of_similar_pairs_that_meet():
    met = total = 0
    for s in range(300):
        a, draw = words(700 + s, 40).split(), random.Random(s)
        b = [w if draw.random() > 0.07 else words(draw.randrange(10**6), 1) for w in a]
        x, y = " ".join(a), " ".join(b)
        if 0.8 <= similar(x, y) < 0.9:
            keys = lines.band_keys([x, y])
            total, met = total + 1, met + (keys[0] == keys[1]).any()
    assert total > 50 and met >= 0.98 * total


def test_long_lines(spark):
    long = words(3, 3000)
    docs = [(0, long), (1, edited(long, 5, 40))]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == {0: long, 1: ""}


def test_odd_rows_and_columns(spark):
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id line of its own"), (None, "one")]
    df = documents(spark, docs, "7 as n_lines", "'x' as _kept", "'y' as lid")
    out = lines.dedup_lines(df)
    assert out.columns[: len(df.columns)] == df.columns
    found = {(r.doc_id, r.text) for r in out.collect()}
    assert (None, "no id line of its own") in found and (None, "") in found
    assert out.count() == len(docs)
    assert {r["n_lines"] for r in out.select("n_lines").collect()} == {7}


def test_repeated_rows_and_empty_table(spark):
    row = (1, "some line that repeats")
    out = lines.dedup_lines(documents(spark, [row, row])).collect()
    assert sorted(r.text for r in out) == ["", row[1]]
    missing = [(None, "a line of rows without an id"), (None, "a line of rows without an id\nand one more"), (None, None)]
    out = lines.dedup_lines(documents(spark, [*missing, (4, "x\n\na line"), (4, "a line\n\nx\nown")]))
    found = sorted(line for r in out.collect() for line in r.text.split("\n") if line)
    assert found == ["a line", "a line of rows without an id", "and one more", "own", "x"]
    assert lines.dedup_lines(documents(spark, [])).collect() == []


def shared_passage(n, twins):
    """`n` lines with one passage and own words; `twins` of them get a near copy."""
    passage = words(1, 24)
    group = [f"{words(5000 + i, 3)} {passage} {words(9000 + i, 4)}" for i in range(n)]
    near = []
    for j in range(twins):
        line = group[j * (n // twins)]
        at, own = len(line) // 3, words(20000 + j, 8)[: j % 15 + 1]
        near.append(line[:at] + own + line[at + len(own) :])
    return group, near


@pytest.mark.parametrize("meet", [2, lines.MEET])
def test_twins_in_a_group_that_shares_a_passage(spark, monkeypatch, meet):
    monkeypatch.setattr(lines, "MEET", meet)
    group, near = shared_passage(300, 100)
    docs = [(i, line) for i, line in enumerate([*group, *near])]
    expected = brute(docs)
    assert sum(not text for text in expected.values()) >= 40
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == expected


def similar(a, b):
    """Jaccard similarity over shingles of 5 ASCII characters."""
    x, y = ({s[i : i + 5] for i in range(max(1, len(s) - 4))} for s in (a, b))
    return len(x & y) / len(x | y)


def test_short_lines_with_one_character_replaced(spark):
    docs = []
    for i, size in enumerate((20, 40, 48, 49, 60, 88, 118)):
        line = words(300 + i, 60)[:size]
        middle = size // 2
        docs += [(2 * i, line), (2 * i + 1, line[:middle] + "#" + line[middle + 1 :])]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    for (a, line), (b, near) in zip(docs[::2], docs[1::2]):
        assert (similar(line, near) >= 0.8) == (len(line) >= 49)
        assert (found[a], found[b]) == (line, "" if len(line) >= 49 else near)


def test_long_lines_of_few_shingles(spark):
    repeated = [(c * 60, c * 150, c * 160) for c in "-=*~.+_#01"]
    rules = [("ab " * 30, "ab " * 60, "ab " * 200), ("+---" * 20, "+---" * 50, "+---" * 70)]
    docs = [(i, "\n".join(group)) for i, group in enumerate(repeated + rules)]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == {i: text.split("\n")[0] for i, text in docs}


def test_sketches_differ_in_no_more_bits_than_the_lines_in_shingles():
    base = words(60, 50)
    own = [base, *(edited(base, s, s % 9) for s in range(30)), words(61, 40), "exact", "-" * 4000, words(62, 30_000), "😀 " * 9]
    counts, sketch = lines.line_sketches(own)
    sets = [{x.encode("utf-16-be", "surrogatepass")[2 * i : 2 * i + 10] for i in range(len(x) - 4)} for x in own]
    assert counts.tolist() == [len(s) for s in sets]
    pruned = 0
    for a in range(len(own)):
        assert (lines.line_sketches([own[a]])[1][0] == sketch[a]).all()
        for b in range(a):
            apart = sum(int(x).bit_count() for x in (sketch[a] ^ sketch[b]).view("uint64"))
            assert apart <= len(sets[a] ^ sets[b])
            alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            ruled_out = apart > (len(sets[a]) + len(sets[b])) / 9 + 1
            assert not (ruled_out and alike >= 0.8)
            pruned += ruled_out and alike < 0.7
    assert pruned > 100


@pytest.mark.parametrize("meet", [2, lines.MEET])
def test_copies_too_far_apart_are_not_compared_pair_by_pair(spark, monkeypatch, meet):
    """Edited copies of one line share buckets, but few pairs of them are similar."""
    monkeypatch.setattr(lines, "MEET", meet)
    judge, judged = lines.judge_pairs, []
    monkeypatch.setattr(lines, "judge_pairs", lambda pairs, t: judged.append(pairs.count()) or judge(pairs, t))
    base = words(70, 80)
    docs = [(i, edited(base, i, 3 if i % 20 == 0 else 8)) for i in range(200)]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == brute(docs)
    assert 0 < sum(judged) < 5 * len(docs)


def test_buckets_of_two_lines_are_settled_at_once(spark, monkeypatch):
    """What lines met in a bucket of their own is not written again for the later steps."""
    written, write = {}, lines.materialize

    def materialize(df, label, *more):
        copy = write(df, label, *more)
        written[label] = written.get(label, 0) + copy.count()
        return copy

    monkeypatch.setattr(lines, "materialize", materialize)
    docs = []
    for i in range(40):
        line = words(800 + i, 60)
        docs += [(2 * i, line), (2 * i + 1, edited(line, i, 1 + i % 6))]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == brute(docs)
    assert written["members"] > 80 and written["rooted"] == 0


def test_only_lines_of_very_large_buckets_are_taken_apart(spark, monkeypatch):
    """300 lines around one passage meet by their sketches; no table of their shingles is written."""
    labels, write = [], lines.materialize
    monkeypatch.setattr(lines, "materialize", lambda df, label, *more: labels.append(label) or write(df, label, *more))
    group, near = shared_passage(300, 100)
    docs = [(i, line) for i, line in enumerate([*group, *near])]
    found = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert found == brute(docs)
    assert "pairs" in labels and not {"near", "postings"} & {*labels}


@pytest.mark.parametrize("pairs, part", [(50, 30), (1 << 18, 1 << 18)])
def test_buckets_are_the_lines_that_share_a_key(spark, monkeypatch, pairs, part):
    """Every band key crosses once; of a key that very many lines have none is left out."""
    monkeypatch.setattr(lines, "PAIRS", pairs)
    monkeypatch.setattr(lines, "PART", part)
    hot = words(900, 50)
    own = [words(s, 20) for s in range(40)] + [f"{hot}{'-' * (6 + i)}" for i in range(60)] + ["abc"]
    df = spark.createDataFrame(list(enumerate(own)), "lid long, line string").repartition(3)
    buckets = {}
    for i, line in enumerate(own[:-1]):
        for key in lines.band_keys([line])[0].tolist():
            buckets.setdefault(key, []).append(i)
    expected = sorted((k, i, min(x), len(x)) for k, x in buckets.items() if len(x) > 1 for i in x)
    assert len(expected) > 500
    found = lines.bucket_members(df).select("key", "lid", "first", "n").collect()
    assert sorted(map(tuple, found)) == expected


def test_many_pairs_are_judged_as_one_by_one():
    base = [words(s, 2 + 7 * (s % 20)) for s in range(300)]
    pairs = [(x, edited(x, s, s % 9)) for s, x in enumerate(base)]
    pairs += [("", ""), ("", "a"), ("abc", "abc"), ("abc", "abd"), ("abcd", "abcde"), ("-" * 9, "-" * 700)]
    pairs += [("😀" * 3, "😀" * 4), ("😀 ü" * 9, "😀 ü" * 8 + "x"), (words(1, 30_000), edited(words(1, 30_000), 1, 900))]
    expected = [len(shingles(x) & shingles(y)) >= 0.8 * len(shingles(x) | shingles(y)) for x, y in pairs]
    assert 100 < sum(expected) < len(pairs) - 50
    a, b = zip(*pairs)
    assert np.array_equal(lines.similar_pairs(list(a), list(b), 0.8), expected)
