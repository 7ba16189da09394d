from __future__ import annotations

import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken
from helpers import ODD_TEXTS, documents, words
from parampipe.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    draw = random.Random(5)
    mixed = ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 0x3000)])) for _ in range(400)) for _ in range(40)]
    return [*mixed, *[words(i, 200) for i in range(20)], "<|endoftext|> it's 1234", " \n\n  x" * 50, "ab" * 700, "\t" * 900]


def test_same_ids_as_the_library(spark):
    rows = texts() + ODD_TEXTS
    df = bpe.decode(bpe.encode(documents(spark, rows, "1 as t"), RANKS, public_tokenizers.PATTERN), RANKS)
    found = {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in df.collect()}
    assert found == {i: (bpe.packed(LIBRARY.encode_ordinary(t or "")), (t or "").encode()) for i, t in enumerate(rows)}


def test_blocks_do_not_show(monkeypatch):
    vocabulary = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    expected = [bpe.packed(LIBRARY.encode_ordinary(t)) for t in texts()]
    for name, value in (("TEXT_BLOCK", 150), ("WORD_BLOCK", 7), ("ID_BLOCK", 11), ("KNOWN_WORDS", 30), ("LONG_WORD", 12)):
        monkeypatch.setattr(bpe, name, value)
    encoder = bpe.Encoder(vocabulary)
    assert encoder.encode(texts()) == expected
    assert bpe.decoded(vocabulary.connect(), vocabulary.known, expected) == [t.encode() for t in texts()]


def test_worker_keeps_words_that_came_again():
    vocabulary = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    vocabulary.name = "own"
    encoder = bpe.Encoder(vocabulary)
    for text in (" zqxa zqxb zqxb", " zqxc zqxa", " zqxd"):
        assert encoder.encode([text]) == [bpe.packed(LIBRARY.encode_ordinary(text))]
    encoder.close()
    with pytest.raises(duckdb.ConnectionException):
        encoder.con.sql("SELECT 1")
    later = bpe.Encoder(vocabulary)
    assert set(later.before) == {" zqxa"}
    # a word of one block only is encoded again when it does come back
    assert later.encode([" zqxb zqxa"]) == [bpe.packed(LIBRARY.encode_ordinary(" zqxb zqxa"))]
    later.close()


def test_heap_contracts_like_the_query():
    draw = random.Random(2)
    for _ in range(200):
        word = bytes(draw.choice(b"abcde the") for _ in range(draw.randrange(1, 40)))
        assert bpe.contract_long(word, RANKS) == LIBRARY._encode_single_piece(word)


def test_digests(spark):
    rows = documents(spark, ["hello world", None, None])
    found = bpe.digests(rows, RANKS, public_tokenizers.PATTERN).collect()
    one = next(r for r in found if r.doc_id == 0)
    ids = LIBRARY.encode_ordinary("hello world")
    assert one.n_tokens == len(ids) and one.ids_sha256 == hashlib.sha256(bpe.packed(ids)).hexdigest()
    assert one.decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert [r.n_tokens for r in found if r.doc_id] == [0, 0]
    assert bpe.digests(documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_unknown_id_raises():
    vocabulary = bpe.Vocabulary(RANKS, "")
    with pytest.raises(ValueError):
        bpe.decoded(vocabulary.connect(), vocabulary.known, [bpe.packed([10**6])])


def test_columns_with_the_names_of_results(spark):
    df = documents(spark, ["some text", None], "7 as ids", "'x' as decoded")
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == [*df.columns, "_ids"]
    back = bpe.decode(coded, RANKS, ids="_ids")
    assert sorted((r.ids, r.decoded, bytes(r["_decoded"])) for r in back.collect()) == [(7, "x", b""), (7, "x", b"some text")]
