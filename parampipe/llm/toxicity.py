"""Toxicity of texts: a linear classifier of character n-grams scaled by naive Bayes ratios.

Every n-gram bucket has a log-count ratio: how much commoner it is among toxic labelled
documents than among the others, counted over all labelled training documents. A text's
features are its n-gram counts times those ratios; logistic regression on a bounded
sample of the same documents sets their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ID, fresh, ship_with_tasks, whole_text
from parampipe.session import materialize

ship_with_tasks(__name__)

# Characters of an n-gram, and buckets their hashes fall into (a power of two).
SIZES = (4, 5, 6)
BUCKET_BITS = 19
# An n-gram found more often in one text counts this often.
MOST_COUNT = 20
# A bucket is a feature when this many training documents have it and its log ratio is this large.
LEAST_DOCUMENTS = 5
LEAST_RATIO = 1.2
SMOOTHING = 1.0
# Documents of each class that the weights are fitted on: those with the least hashes of their ids.
SAMPLE_TOXIC = 4_000
SAMPLE_OTHER = 8_000
RIDGE = 0.01
STEPS = 120
RATE = 0.02
THRESHOLD = 0.7
# Rows of a result batch.
ROWS = 512

PART_SCHEMA = "bucket int, toxic long, other long, label int, h long, text string"
_PART = pa.schema(
    [("bucket", pa.int32()), ("toxic", pa.int64()), ("other", pa.int64()), ("label", pa.int32()), ("h", pa.int64()), ("text", pa.string())]
)
# Bucket of the rows that hold the number of documents.
DOCUMENTS = -1


@dataclass(frozen=True)
class Model:
    """Value of one occurrence of each bucket's n-grams, and the value of an empty text."""

    values: np.ndarray
    bias: float


def grams(text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of all n-grams of a text, repeats included.

    Letters are lower-cased, white space is one blank, and a blank stands at either end.
    """
    text = f" {' '.join(text.lower().split())} "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    found, h, step = [], np.zeros(len(codes), dtype=np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for size in range(1, max(SIZES) + 1):
        if size > len(codes):
            break
        h = (h[: len(codes) - size + 1] + codes[size - 1 :] + np.uint64(1)) * step
        h ^= h >> np.uint64(32)
        if size in SIZES:
            found.append(((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def counted(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets, and how often each is there, up to `MOST_COUNT`."""
    own, times = np.unique(buckets, return_counts=True)
    return own, np.minimum(times, MOST_COUNT)


def held_out(doc_id: Column) -> Column:
    """True for ids whose CRC-32 of the decimal text leaves 1 by 3; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """Columns (doc_id, label, h): one label for each id that may be learnt from.

    Rows without an id or a label take no part; an id with several labels is toxic if one says so.
    """
    known = labels.select(F.col(ID).cast("long").alias(ID), F.col("toxic").cast("long").alias("toxic"))
    known = known.where(F.col(ID).isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(ID)))
    known = known.groupBy(ID).agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    return known.withColumn("h", F.xxhash64(ID))


def sample_limits(marks: DataFrame) -> dict[int, int]:
    """The greatest hash of the sampled ids of each label."""
    limits = {}
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_OTHER)):
        chosen = marks.where(F.col("label") == label).select("h").orderBy("h").limit(most)
        top = chosen.agg(F.max("h")).first()[0]
        limits[label] = -(1 << 63) if top is None else top
    return limits


def count_parts(rows: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """Rows of `PART_SCHEMA` from rows (text, label, h, sampled): the documents of either
    label that have an n-gram of a bucket, once for each task, and the texts of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having = np.zeros((2, 1 << bits), dtype=np.int64)
        total = [0, 0]
        for batch in batches:
            texts, labels, hashes, sampled = (c.to_pylist() for c in batch.columns)
            for text, label in zip(texts, labels):
                having[label, np.unique(grams(text, bits))] += 1
                total[label] += 1
            chosen = [i for i, s in enumerate(sampled) if s]
            for first in range(0, len(chosen), ROWS):
                own = chosen[first : first + ROWS]
                none = pa.nulls(len(own))
                columns = [none, none, none, *(pa.array([v[i] for i in own]) for v in (labels, hashes, texts))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _PART)], schema=_PART)
        some = np.flatnonzero(having.any(axis=0))
        buckets = np.concatenate([[DOCUMENTS], some])
        none = pa.nulls(len(buckets))
        columns = [pa.array(buckets), *(pa.array(np.concatenate([[total[k]], having[k, some]])) for k in (1, 0)), none, none, none]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _PART)], schema=_PART)

    return rows.select("text", "label", "h", "sampled").mapInArrow(run, PART_SCHEMA)


def log_ratios(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratios of all buckets; 0 where they are no feature."""
    p, q = toxic + SMOOTHING, other + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where((toxic + other >= LEAST_DOCUMENTS) & (np.abs(ratio) >= LEAST_RATIO), ratio, 0.0)


def sample_features(sample: DataFrame, ratios: np.ndarray, bits: int = BUCKET_BITS) -> pd.DataFrame:
    """Label, buckets and counts (as bytes) of every sampled text, features only."""
    is_feature = ratios != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = grams(text, bits)
                own, times = counted(found[is_feature[found]])
                rows.append((own.astype(np.int32).tobytes(), times.astype(np.uint8).tobytes()))
            columns = [pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["label", "buckets", "times"])

    return sample.select("label", "text").mapInArrow(run, "label int, buckets binary, times binary").toPandas()


def fit_weights(features: pd.DataFrame, ratios: np.ndarray, documents: tuple[int, int]) -> Model:
    """Logistic regression by Adam with a ridge; each class weighs as its (toxic, other) `documents` do."""
    bias = float(np.log((documents[0] + 0.5) / (documents[1] + 0.5)))
    y = features["label"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(len(ratios)), bias)
    buckets = [np.frombuffer(b, dtype=np.int32) for b in features["buckets"]]
    times = np.concatenate([np.frombuffer(t, dtype=np.uint8) for t in features["times"]])
    row = np.repeat(np.arange(len(y)), [len(b) for b in buckets])
    own, column = np.unique(np.concatenate(buckets), return_inverse=True)
    x = ratios[own][column] * times
    share = np.where(y == 1, documents[0] / max(1, (y == 1).sum()), documents[1] / max(1, (y == 0).sum()))
    share /= share.sum()
    weights, moves, sizes = np.zeros(len(own)), np.zeros(len(own)), np.zeros(len(own))
    move = size = 0.0
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights=weights[column] * x, minlength=len(y)) + bias
        error = share * (logistic(z) - y)
        slope = np.bincount(column, weights=error[row] * x, minlength=len(own)) + RIDGE * weights
        moves, sizes = 0.9 * moves + 0.1 * slope, 0.99 * sizes + 0.01 * slope**2
        move, size = 0.9 * move + 0.1 * error.sum(), 0.99 * size + 0.01 * error.sum() ** 2
        rate = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * moves / (np.sqrt(sizes) + 1e-9)
        bias -= rate * move / (np.sqrt(size) + 1e-9)
    values = np.zeros(len(ratios))
    values[own] = weights * ratios[own]
    return Model(values, float(bias))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BUCKET_BITS) -> Model:
    """The model of all labelled documents that are not held out.

    Counts are over every such document; the weights are fitted on `SAMPLE_TOXIC` and
    `SAMPLE_OTHER` of them at most. Without labels of both kinds the score is a constant.
    """
    marks = materialize(training_labels(labels), "labels")
    limits = sample_limits(marks)
    sampled = F.col("h") <= F.when(F.col("label") == 1, F.lit(limits[1])).otherwise(F.lit(limits[0]))
    texts = docs.select(F.col(ID).cast("long").alias(ID), whole_text().alias("text")).where(~held_out(F.col(ID)))
    # labels grow with the documents, so they are not broadcast however few they are here
    rows = texts.join(marks.hint("merge"), ID).withColumn("sampled", sampled)
    parts = materialize(count_parts(rows, bits), "grams", "zstd")
    counts = parts.where("bucket is not null").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # one row for each bucket at most
    counts = counts.toPandas()
    sums = np.zeros((2, 1 << bits))
    own = counts[counts["bucket"] != DOCUMENTS]
    for k, name in enumerate(("toxic", "other")):
        sums[k, own["bucket"].to_numpy(dtype=np.int64)] = own[name].to_numpy(dtype=float)
    documents = tuple(int(counts.loc[counts["bucket"] == DOCUMENTS, c].sum()) for c in ("toxic", "other"))
    ratios = log_ratios(*sums)
    # repeated rows of one id can exceed the bound
    most = SAMPLE_TOXIC + SAMPLE_OTHER
    sample = parts.where("text is not null").orderBy("h", "text").limit(most)
    return fit_weights(sample_features(sample, ratios, bits), ratios, documents)


def score_column(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    values, bias = model.values.astype(np.float32), model.bias
    bits = len(values).bit_length() - 1

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        sums = np.empty(len(texts))
        for i, text in enumerate(texts):
            found = grams(text, bits)
            own, times = counted(found[values[found] != 0])
            sums[i] = (values[own].astype(np.float64) * times).sum()
        return pd.Series(logistic(sums + bias))

    return of(text)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` and the columns held_out, score and predicted (under free names).

    Only the text makes the score. Null texts count as empty and have no n-gram, like
    texts of a character or two: their score is the model's constant. Rows without an
    id are not held out, and never learnt from. Repeated rows are scored alike; an
    empty table gives no rows.
    """
    out, score, predicted = (fresh(docs, n) for n in ("held_out", "score", "predicted"))
    rows = docs.withColumn(score, score_column(whole_text(), model))
    return rows.select(
        *docs.columns,
        held_out(F.col(ID)).alias(out),
        score,
        (F.col(score) >= THRESHOLD).cast("int").alias(predicted),
    )
