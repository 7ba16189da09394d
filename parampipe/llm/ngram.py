"""Language-model scores by deleted interpolation of word bigrams.

P(w | v) mixes the maximum-likelihood estimates of bigram and unigram with a
uniform one; the weights depend on how often the context v was seen and come
from expectation-maximisation on the counts of a held-out part of the training
documents.

Texts become blocks of word numbers. A block asks for the counts of its own
different words and pairs, once each; keys are dealt over buckets by their hash,
where a bucket adds up what all blocks bring and answers each in its own order.
No vocabulary is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ID, ship_with_tasks, whole_text
from parampipe.session import materialize, release_shuffles

ship_with_tasks(__name__)

FOLDS = 10
TEST, HELD, TRAIN = 0, 1, 2
# Bytes of text of a block, and of the corpus for a bucket of keys.
BLOCK_BYTES = 5 << 20
BUCKET_BYTES = 6 << 20
# Context frequencies fall into buckets by their binary logarithm, up to this one.
FREQUENCIES = 24
# Ratios of estimates are counted in steps of 1 / GRAIN of a binary logarithm.
GRAIN = 8
ROUNDS = 60
LEAST_WEIGHT = 1e-6
# Weights (bigram, unigram, uniform) without any held-out text.
PRIOR = (0.4, 0.5, 0.1)

BLOCK_SCHEMA = "block long, role int, doc_ids binary, no_id binary, lengths binary, tokens binary, words binary"
KEY_SCHEMA = "kind int, bucket int, block long, role int, keys binary, counts binary"
ANSWER_SCHEMA = (
    "block long, role int, kind int, bucket int, all_counts binary, kept_counts binary, "
    "all_distinct long, all_tokens long, kept_distinct long, kept_tokens long"
)
WORDS, PAIRS = 0, 1


def fold(doc_id: Column) -> Column:
    """Remainder by 10 of the CRC-32 of the id as text (null: empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS).cast("int")


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit key per ordered pair of word hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ np.uint64(0xC2B2AE3D27D4EB4F))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray, sorted_values: bool = False) -> bytes:
    """Numbers as compressed bytes: all first bytes, all second bytes and so on, of the
    steps between them where they are sorted. Most counts and high bytes are alike."""
    if sorted_values:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, dtype: type, sorted_values: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    planes = raw.reshape(np.dtype(dtype).itemsize, -1)
    values = np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if sorted_values else values


# Keys of the end token, which also is the context of a first word; no word holds a newline.
END = b"\n"


def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `BLOCK_SCHEMA`: documents of one role as numbers into the block's own words."""
    part, made = TaskContext.get().partitionId(), 0
    waiting: dict[int, list] = {TEST: [], HELD: [], TRAIN: []}
    sizes = dict.fromkeys(waiting, 0)

    def flush(role: int) -> pa.RecordBatch:
        nonlocal made
        numbers: dict[bytes, int] = {END: 0}
        ids, missing, lengths, tokens = [], [], [], []
        for doc_id, text in waiting[role]:
            words = text.lower().split()
            tokens.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
            tokens.append(np.zeros(1, dtype=np.int32))
            lengths.append(len(words) + 1)
            ids.append(0 if doc_id is None else doc_id)
            missing.append(doc_id is None)
        waiting[role], sizes[role] = [], 0
        made += 1
        row = {
            "block": [(part << 32) + made],
            "role": [role],
            "doc_ids": [np.array(ids, dtype=np.int64).tobytes()],
            "no_id": [np.array(missing, dtype=np.uint8).tobytes()],
            "lengths": [np.array(lengths, dtype=np.int64).tobytes()],
            "tokens": [pack(np.concatenate(tokens))],
            "words": [word_hashes(list(numbers)).tobytes()],
        }
        return pa.RecordBatch.from_pydict(
            row, schema=pa.schema([("block", pa.int64()), ("role", pa.int32()), *[(c, pa.binary()) for c in list(row)[2:]]])
        )

    for batch in batches:
        # texts are taken one by one, as the bytes they are
        for doc_id, rest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            role, raw = min(rest, TRAIN), text.as_py()
            if waiting[role] and sizes[role] + len(raw) > BLOCK_BYTES:
                yield flush(role)
            waiting[role].append((doc_id, raw))
            sizes[role] += len(raw)
    for role in waiting:
        if waiting[role]:
            yield flush(role)


class Opened:
    """A block's tokens, and the keys of its words and pairs in the order they are asked for."""

    def __init__(self, row, buckets: int):
        self.lengths = np.frombuffer(row.lengths, dtype=np.int64)
        self.tokens = unpack(row.tokens, np.int32)
        words = np.frombuffer(row.words, dtype=np.uint64)
        before = np.empty_like(self.tokens)
        # the token before; the end token before a first word
        before[0], before[1:] = 0, self.tokens[:-1]
        self.before = before
        joined = (before.astype(np.int64) << 32) | self.tokens
        pairs, self.pair_of, self.pair_counts = np.unique(joined, return_inverse=True, return_counts=True)
        pair_keys = pair_hashes(words[pairs >> 32], words[pairs & 0xFFFFFFFF])
        self.keys, self.order, self.starts = [], [], []
        for keys in (words, pair_keys):
            bucket = keys % np.uint64(buckets)
            order = np.lexsort((keys, bucket))
            self.keys.append(keys)
            self.order.append(order)
            self.starts.append(np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64)))

    def counts(self, kind: int) -> np.ndarray:
        return np.bincount(self.tokens, minlength=len(self.keys[WORDS])) if kind == WORDS else self.pair_counts

    def answers(self, rows: pd.DataFrame, column: str) -> list[np.ndarray]:
        """Totals of each word and each pair of the block, from the buckets' answers."""
        found = []
        for kind in (WORDS, PAIRS):
            totals = np.zeros(len(self.keys[kind]), dtype=np.int64)
            own = rows[rows["kind"] == kind]
            for bucket, packed in zip(own["bucket"], own[column]):
                a, b = self.starts[kind][bucket], self.starts[kind][bucket + 1]
                totals[self.order[kind][a:b]] = unpack(packed, np.int64)
            found.append(totals)
        return found


def bucket_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-size // BUCKET_BYTES))


def ask(blocks: DataFrame, buckets: int) -> DataFrame:
    """Rows of `KEY_SCHEMA`: each block's different keys and counts, by bucket."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                opened = Opened(row, buckets)
                for kind in (WORDS, PAIRS):
                    order, starts = opened.order[kind], opened.starts[kind]
                    keys, counts = opened.keys[kind][order], opened.counts(kind)[order].astype(np.int64)
                    rows = [
                        (kind, b, row.block, row.role, pack(keys[s:e], True), pack(counts[s:e]))
                        for b, (s, e) in enumerate(zip(starts, starts[1:]))
                        if e > s
                    ]
                    yield pd.DataFrame(rows, columns=["kind", "bucket", "block", "role", "keys", "counts"])

    return blocks.mapInPandas(run, KEY_SCHEMA)


def places(keys: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Place of every key among the different keys of all arrays, and their number.

    Takes the arrays out of the list; places of 32 bits, as a bucket is small.
    """
    ends = np.cumsum([len(k) for k in keys])
    flat = np.concatenate(keys)
    keys.clear()
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    place = np.empty(len(flat), dtype=np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return np.split(place, ends[:-1]), int(new.sum())


def answer(asked: DataFrame) -> DataFrame:
    """Rows of `ANSWER_SCHEMA`: totals over all training blocks, in the order asked.

    ``all`` counts every training document, ``kept`` those that are not held out.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        place, distinct = places([unpack(k, np.uint64, True) for k in rows["keys"]])
        held, kept = np.zeros(distinct, dtype=np.int64), np.zeros(distinct, dtype=np.int64)
        for role, at, packed in zip(rows["role"], place, rows["counts"]):
            # a block asks for each key once, so no place is met twice here
            if role != TEST:
                (held if role == HELD else kept)[at] += unpack(packed, np.int64)
        whole, out = held + kept, []
        sums = (int((whole > 0).sum()), int(whole.sum()), int((kept > 0).sum()), int(kept.sum()))
        for row, at in zip(rows.itertuples(), place):
            own_kept = pack(kept[at]) if row.role == HELD else None
            out.append((row.block, row.role, row.kind, row.bucket, pack(whole[at]), own_kept, *sums))
            sums = (0, 0, 0, 0)
        return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER_SCHEMA.split(", ")])

    return asked.groupBy("kind", "bucket").applyInPandas(run, ANSWER_SCHEMA)


def frequency(context: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for unseen, else by binary logarithm."""
    return np.minimum(FREQUENCIES, np.ceil(np.log2(context.astype(float) + 1)).astype(np.int64))


def ratios(opened: Opened, words: np.ndarray, pairs: np.ndarray, tokens: int, distinct: int):
    """Context bucket, and bigram and unigram estimates as multiples of the uniform one."""
    context = words[opened.before]
    seen = np.maximum(context, 1)
    bigram = pairs[opened.pair_of] / seen * (distinct + 1)
    unigram = words[opened.tokens] / max(1, tokens) * (distinct + 1)
    return frequency(context), bigram, unigram


def held_out_counts(blocks: DataFrame, answers: DataFrame, buckets: int, tokens: int, distinct: int) -> DataFrame:
    """Columns (f, b, u, n): held-out tokens by context bucket and the steps of both ratios.

    At most (FREQUENCIES + 1) * (64 * GRAIN) ** 2 rows, whatever the corpus.
    """

    def run(_key: tuple, own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in own.itertuples():
            opened = Opened(row, buckets)
            f, bigram, unigram = ratios(opened, *opened.answers(found, "kept_counts"), tokens, distinct)
            steps = [
                np.where(r > 0, np.round(GRAIN * np.log2(np.where(r > 0, r, 1))), -(10**6)).astype(np.int64)
                for r in (bigram, unigram)
            ]
            frame = pd.DataFrame({"f": f, "b": steps[0], "u": steps[1]})
            parts.append(frame.groupby(["f", "b", "u"]).size().rename("n").reset_index())
        return pd.concat(parts) if parts else pd.DataFrame(columns=["f", "b", "u", "n"], dtype="int64")

    held = blocks.where(F.col("role") == HELD).groupBy("block")
    asked = answers.where(F.col("role") == HELD).groupBy("block")
    counted = held.cogroup(asked).applyInPandas(run, "f long, b long, u long, n long")
    return counted.groupBy("f", "b", "u").agg(F.sum("n").alias("n"))


def learn_weights(counts: pd.DataFrame) -> np.ndarray:
    """Weights (bigram, unigram, uniform) for each context bucket, by EM on held-out counts."""
    weights = np.tile(np.array(PRIOR), (FREQUENCIES + 1, 1))
    if len(counts):
        size = counts["n"].to_numpy(dtype=float)
        terms = np.stack(
            [
                np.where(counts[c].to_numpy() > -(10**6), 2.0 ** (counts[c].to_numpy().clip(-(10**5)) / GRAIN), 0.0)
                for c in ("b", "u")
            ]
            + [np.ones(len(counts))],
            axis=1,
        )
        f = counts["f"].to_numpy()
        # buckets without held-out tokens take the weights of all
        weights[:] = _maximise(terms, size)
        for bucket in np.unique(f):
            weights[bucket] = _maximise(terms[f == bucket], size[f == bucket])
    weights[0, 0] = 0.0  # an unseen context has no bigram estimate
    weights = np.maximum(weights, [0.0, LEAST_WEIGHT, LEAST_WEIGHT])
    return weights / weights.sum(axis=1, keepdims=True)


def _maximise(terms: np.ndarray, size: np.ndarray) -> np.ndarray:
    weights = np.full(3, 1 / 3)
    for _ in range(ROUNDS):
        share = terms * weights
        share /= share.sum(axis=1, keepdims=True)
        weights = (share * size[:, None]).sum(axis=0) / size.sum()
    return weights


def score_blocks(blocks, answers, buckets: int, tokens: int, distinct: int, weights: np.ndarray) -> DataFrame:
    def run(_key: tuple, own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in own.itertuples():
            opened = Opened(row, buckets)
            words, pairs = opened.answers(found, "all_counts")
            count = words[opened.tokens]
            f, bigram, unigram = ratios(opened, words, pairs, tokens, distinct)
            w = weights[f]
            mixed = (w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2]) / (distinct + 1)
            base = (count + 0.1) / (tokens + 0.1 * (distinct + 1))
            starts = np.cumsum(opened.lengths) - opened.lengths
            no_id = np.frombuffer(row.no_id, dtype=np.uint8).astype(bool)
            ids = pd.array(np.frombuffer(row.doc_ids, dtype=np.int64), dtype="Int64")
            ids[no_id] = pd.NA
            parts.append(
                pd.DataFrame(
                    {
                        ID: ids,
                        "held_out": row.role == TEST,
                        "n_tokens": opened.lengths,
                        "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
                        "train_tokens": tokens,
                        "base_score": np.add.reduceat(np.log10(base), starts),
                        "score": np.add.reduceat(np.log10(mixed), starts),
                    }
                )
            )
        return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, SCORE_SCHEMA)


SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document (`SCORE_SCHEMA`), learnt from those that are not held out.

    A document is held out when the CRC-32 of its id as text is divisible by 10 (a null
    id is the empty text, so it is); of the others, remainder 1 is what the weights are
    learnt on, with the counts of the rest, and all of them make the final counts. Only
    A-Z are lower-cased, ASCII white space parts words, and one end token closes a text;
    null and empty texts have that token only. Repeated rows each count and are scored.
    Without training documents the counts are 0 and the fixed weights hold. Other columns
    are not read; an empty table gives no rows. Words and pairs are told apart by 64-bit
    hashes.
    """
    rows = docs.select(F.col(ID).cast("long").alias(ID), fold(F.col(ID)).alias("fold"), whole_text().cast("binary").alias("text"))
    buckets = bucket_count(rows)
    blocks = materialize(rows.mapInArrow(make_blocks, BLOCK_SCHEMA), "blocks")
    answers = materialize(answer(ask(blocks, buckets)), "answers")
    release_shuffles(docs.sparkSession)
    words = answers.where(F.col("kind") == WORDS)
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("all_tokens", "all_distinct", "kept_tokens", "kept_distinct")]).first()
    tokens, distinct, kept_tokens, kept_distinct = (int(x) for x in sums)
    asked = answers.select("block", "role", "kind", "bucket", "all_counts", "kept_counts")
    held = held_out_counts(blocks, asked, buckets, kept_tokens, kept_distinct).toPandas()
    weights = learn_weights(held if kept_tokens else held.iloc[:0])
    release_shuffles(docs.sparkSession)
    return score_blocks(blocks, asked.drop("kept_counts"), buckets, tokens, distinct, weights)
