"""Quality rules: a linear-chain CRF labels lines as content or boilerplate.

The model is fitted on a bounded sample of labelled documents. Their labels are of whole
documents, so the lines' own labels are latent: a model of single lines moves the lines
that contradict their document's label, as long as most lines keep it, and the chain is
learnt on what comes out. Viterbi decoding over the whole text decides; a document is
kept when enough of its word characters lie in content lines and the base rules hold.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import fresh, ship_with_tasks, whole_text

ship_with_tasks(__name__)

# Labelled documents the model is fitted on, and lines taken of each: consecutive ones
# from a place named by the text's checksum where it has more.
SAMPLE_DOCS = 3_000
SAMPLE_LINES = 64
# Times the lines' labels are worked out anew, and the share of a document's lines that
# keeps its label.
RELABELS = 2
LEAST_OWN_SHARE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
STEPS = 150
RIDGE = 1.0

# Characters that count as symbols, and ASCII white space.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))

FEATURES = 9
CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class Model:
    """Scores of the two labels: of a line by its features, of a step, and at the start."""

    weights: np.ndarray
    steps: np.ndarray
    start: np.ndarray


def no_boilerplate() -> Model:
    """Without labels of both kinds every line is content."""
    weights = np.zeros((FEATURES, 2))
    weights[0, CONTENT] = 1.0
    return Model(weights, np.zeros((2, 2)), np.zeros(2))


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row of features for every line of a document, in order."""
    seen: set[bytes] = set()
    rows = []
    for line in lines:
        words = line.split()
        n, size = len(words), len(line)
        upper = size - len(line.translate(None, _UPPER))
        lower = size - len(line.translate(None, _LOWER))
        repeated = n > 0 and line in seen
        seen.add(line)
        rows.append(
            (
                1.0,
                float(n == 0),
                (size - len(line.translate(None, SYMBOLS))) / (size + 1),
                line.count(b"!") / (n + 1),
                upper / (upper + lower + 1),
                min(1.0, line.count(b"|") / (n + 1)),
                float(n > 0 and words[-1][-1:] in (b".", b"?", b'"', b":")),
                (size - len(line.translate(None, _DIGIT))) / (size + 1),
                float(repeated),
            )
        )
    return np.array(rows, dtype=np.float64).reshape(-1, FEATURES)


def viterbi(scores: np.ndarray, steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Labels of the best path; on a tie the first label (content)."""
    n = len(scores)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    (s00, s01), (s10, s11) = steps.tolist()
    rows = scores.tolist()
    a, b = rows[0][0] + start[0], rows[0][1] + start[1]
    from_a, from_b = [0], [0]
    for x, y in rows[1:]:
        aa, ba, ab, bb = a + s00, b + s10, a + s01, b + s11
        from_a.append(int(ba > aa))
        from_b.append(int(bb > ab))
        a, b = x + (ba if ba > aa else aa), y + (bb if bb > ab else ab)
    label, path = int(b > a), []
    for i in range(n - 1, -1, -1):
        path.append(label)
        label = from_b[i] if label else from_a[i]
    return np.array(path[::-1], dtype=np.int64)


def fit(
    sequences: list[np.ndarray], labels: list, steps: int = STEPS, ridge: float = RIDGE, chained: bool = True
) -> Model:
    """Maximum likelihood of the label sequences, with a ridge on all scores, by Adam.

    `sequences` holds feature rows per document, `labels` the labels of its lines or one
    for all of them. Without `chained` every line stands alone: no step or start has a score.
    """
    kept = [(x, np.broadcast_to(y, len(x))) for x, y in zip(sequences, labels) if len(x)]
    if len({int(v) for _, y in kept for v in np.unique(y)}) < 2:
        return no_boilerplate()
    longest, n = max(len(x) for x, _ in kept), len(kept)
    x = np.zeros((n, longest, FEATURES))
    live = np.zeros((n, longest), dtype=bool)
    truth = np.zeros((n, longest, 2))
    for i, (rows, own) in enumerate(kept):
        x[i, : len(rows)], live[i, : len(rows)] = rows, True
        truth[i, np.arange(len(rows)), own] = 1.0
    both = live[:, 1:] & live[:, :-1]
    # what the labels say, once; the model's expectations follow in every step
    goal = [
        np.einsum("ntf,ntk->fk", x, truth),
        np.einsum("ntj,ntk->jk", truth[:, :-1], truth[:, 1:]),
        truth[:, 0].sum(axis=0),
    ]
    values = [np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
    lines = live.sum()
    for step in range(1, steps + 1):
        expected = _expectations(x, live, both, *values) if chained else _alone(x, live, values[0])
        for i, value in enumerate(values[: len(expected)]):
            slope = (goal[i] - expected[i] - ridge * value) / lines
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            rate = 0.2 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            values[i] = value + rate * first[i] / (np.sqrt(second[i]) + 1e-9)
    return Model(*values)


def relabel(rows: np.ndarray, label: int, model: Model) -> np.ndarray:
    """Labels of a document's lines: the likelier by single lines, while at least
    `LEAST_OWN_SHARE` of them, those that contradict it least, keep the document's `label`."""
    margin = (rows @ model.weights) @ np.array([1.0, -1.0])  # above 0: content
    against = margin if label == BOILERPLATE else -margin
    moved = np.argsort(-against, kind="stable")[: len(rows) - math.ceil(LEAST_OWN_SHARE * len(rows))]
    found = np.full(len(rows), label)
    found[moved[against[moved] > 0]] = BOILERPLATE if label == CONTENT else CONTENT
    return found


def fit_documents(sequences: list[np.ndarray], labels: list[int], rounds: int = RELABELS) -> Model:
    """A chain over latent line labels, learnt from labels of whole documents.

    Starts with every line labelled as its document; each round fits single lines to the
    present labels and works these out anew (`relabel`); the chain is fitted last.
    """
    lines: list = list(labels)
    for _ in range(rounds):
        alone = fit(sequences, lines, chained=False)
        lines = [relabel(x, y, alone) for x, y in zip(sequences, labels)]
    return fit(sequences, lines)


def _alone(x: np.ndarray, live: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Expected counts of features where no line depends on another."""
    scores = x @ weights
    at = np.exp(scores - _sum_out(scores, 2)[:, :, None]) * live[:, :, None]
    return [np.einsum("ntf,ntk->fk", x, at)]


def _sum_out(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expectations(x, live, both, weights, steps, start) -> list[np.ndarray]:
    """Expected counts of features, steps and starts, by the forward-backward sums."""
    scores = x @ weights
    n, longest, _ = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0] + start
    for t in range(1, longest):
        come = _sum_out(forward[:, t - 1, :, None] + steps, 1) + scores[:, t]
        forward[:, t] = np.where(live[:, t, None], come, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        go = _sum_out(steps + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(live[:, t + 1, None], go, 0.0)
    total = _sum_out(forward[:, -1], 1)
    at = np.exp(forward + backward - total[:, None, None]) * live[:, :, None]
    pair = (
        forward[:, :-1, :, None]
        + steps
        + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, None, None, None]
    )
    moves = np.where(both[:, :, None, None], np.exp(np.minimum(pair, 0.0)), 0.0)
    return [np.einsum("ntf,ntk->fk", x, at), moves.sum(axis=(0, 1)), at[:, 0].sum(axis=0)]


def sample_lines(raw: bytes) -> np.ndarray:
    """Features of at most `SAMPLE_LINES` consecutive lines, which know the whole text."""
    rows = line_features(raw.split(b"\n"))
    spare = len(rows) - SAMPLE_LINES
    if spare <= 0:
        return rows
    start = zlib.crc32(raw) % (spare + 1)
    return rows[start : start + SAMPLE_LINES]


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts: dict = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = bytearray(len(words))
    for i in compress(range(len(windows)), (counts[w] > 1 for w in windows)):
        covered[i] = covered[i + 1] = covered[i + 2] = 1
    return sum(covered)


def judge(text: str, model: Model) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, share, kept."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    worded = [line for line in lines if line.strip(SPACE)]
    repeats = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    labels = viterbi(line_features(lines) @ model.weights, model.steps, model.start)
    sizes = np.array([len(line) - sum(map(line.count, (b" ", b"\t", b"\x0b", b"\x0c", b"\r"))) for line in lines])
    total = int(sizes.sum())
    share = float(sizes[labels == CONTENT].sum()) / total if total else 0.0
    kept = not failed and share >= MIN_CONTENT_SHARE
    return (len(words), word_chars, symbols, len(worded) - len(set(worded)), repeats, failed, share, kept)


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def verdict_column(text: Column, model: Model) -> Column:
    """The verdict of a text as a struct (`VERDICT`)."""
    weights, steps, start = model.weights, model.steps, model.start

    @F.pandas_udf(VERDICT)
    def of(texts: pd.Series) -> pd.DataFrame:
        fitted = Model(weights, steps, start)
        names = [part.split()[0] for part in VERDICT.split(", ")]
        return pd.DataFrame([judge(t, fitted) for t in texts], columns=names)

    return of(text)


def sample_features(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """Feature rows (flat) and quality of at most `most` labelled documents.

    The labelled ids with the least hashes are taken; an id with several labels
    takes the least. Ids and labels that are null take no part.
    """
    chosen = labels.where("doc_id is not null and quality is not null")
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: sample_lines(text.encode("utf-8", "surrogatepass")).ravel())

    # at most `most` rows
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.select("doc_id", "quality", features("text").alias("features")).limit(most)


def fit_on_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Model:
    rows = sorted(sample_features(docs, labels, most).toPandas().itertuples(), key=lambda r: r.doc_id)
    sequences = [np.asarray(r.features, dtype=np.float64).reshape(-1, FEATURES) for r in rows]
    return fit_documents(sequences, [CONTENT if r.quality else BOILERPLATE for r in rows])


def judge_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id and the fields of `VERDICT`.

    Null and empty texts have no word and fail the base rules. Without any labelled
    row of either quality every line counts as content.
    """
    rows = docs.select("doc_id", verdict_column(whole_text(), model).alias("v"))
    return rows.select("doc_id", "v.*")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` the rules keep, with all their columns."""
    mark = fresh(docs, "_verdict")
    judged = docs.withColumn(mark, verdict_column(whole_text(), model))
    return judged.where(F.col(mark)["kept"]).select(*docs.columns)
