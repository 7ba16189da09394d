"""The pipeline against plain Python versions of its stages, and odd tables."""

from __future__ import annotations

import hashlib
import random

import pytest
import tiktoken
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import bpe, quality
from parampipe.llm.queries import RANKS, SOURCE_SHARES
from test_lines import brute as kept_text
from test_simhash import components, plain_fingerprint

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")


def corpus():
    """Clean documents, exact and near copies, lines that repeat across documents, junk."""
    docs, passage = [], words(1, 60)
    for i in range(30):
        lines = [words(100 * i + j, 25) + "." for j in range(4)]
        if i % 5 == 0:
            lines.insert(2, passage.replace("a", "e", i % 3))
        docs.append("\n".join(lines))
    docs += docs[:4]
    for i in range(4, 8):
        own = docs[i].split(" ")
        own[3 * i] = "other"
        docs.append(" ".join(own))
    docs += ["#### $$ %% | <> " * 30, "x y " * 100, "too short", None, "", "BUY NOW!!!\n" * 20]
    draw = random.Random(3)
    return [(i, t, draw.choice(["src1", "src2", "src7", "elsewhere", None])) for i, t in enumerate(docs)]


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, *extra):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        documents(spark, rows, *extra).write.parquet(f"{path}/documents.parquet")
        marks = [(r[0], int(r[1] is not None and "#" not in r[1] and "BUY" not in r[1]), 0) for r in rows if r[0] is not None]
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path

    return write


def test_run_against_plain_stages(spark, folder):
    rows = corpus()
    path = folder(rows)
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_on_sample(docs, labels)
    good = [(i, t) for i, t, _ in rows if quality.judge(t or "", model)[-1]]
    assert 25 <= len(good) < len(rows)
    left = kept_text(good)
    ids = [i for i, _ in good]
    groups = components([plain_fingerprint(left[i]) for i in ids], 4)
    stay = [i for i, g in zip(ids, groups) if ids[g] == i]
    assert len(stay) < len(ids)
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for i in stay:
        coded = library.encode_ordinary(left[i])
        packed = b"".join(x.to_bytes(4, "little") for x in coded)
        expected[i] = (len(coded), hashlib.sha256(packed).hexdigest(), hashlib.sha256(left[i].encode()).hexdigest())
    found = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected
    assert len({r.position for r in found}) == len(found)
    # within a source documents come by id
    source = {i: s if s in SOURCE_SHARES else None for i, _, s in rows}
    for name in set(source.values()):
        own = [r.doc_id for r in sorted(found, key=lambda r: r.position) if source[r.doc_id] == name]
        assert own == sorted(own)


def test_odd_rows_and_empty_tables(spark, folder):
    odd = [(None, words(5, 80)), (None, words(5, 80)), (3, words(6, 80)), (3, words(6, 80)), *enumerate(ODD_TEXTS)]
    path = folder(odd, "1 as ids", "'k' as position", "'v' as _verdict", "2 as n_lines")
    found = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found)[-1][0] and len({r.ids_sha256 for r in found}) == len(found)
    assert corpus_pipeline.run(spark, folder([])).collect() == []
