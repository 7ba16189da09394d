"""Periodic runs of words: seeds on diagonals, extended both ways.

A run of smallest period q and length L repeats itself at lag q over L - q words.
Lags are dealt into classes, and a class is searched with word grams as long as the
least overlap its runs can have; two occurrences of a gram name a lag, and the
stretch of equal words along that lag is the run.

Within a class the next occurrence of a gram is enough. Let a gram of k words recur q
words later, q < 2k/3, inside a run of smallest period q, and let p be the gram's own
smallest period. Should p + q <= k, then p divides q and p = q, so nothing nearer is an
occurrence. Should p + q > k, occurrences are p > k - q or more apart, and one between
the two would make q > 2 (k - q), which q < 2k/3 rules out. So seeds grow with the
length of the text, not with the square of a gram's occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ID, ship_with_tasks, whole_text

ship_with_tasks(__name__)

# A run has this many words at least, and this many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
# Rows of a result batch.
ROWS = 1024

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"

_RUN_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN_TYPE), ("collapsed", pa.string())])


def lag_classes(n: int, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> Iterator[tuple[int, int, int]]:
    """(words of a gram, first lag, lag after the last) for all lags of runs in `n` words.

    The gram is as long as the least overlap of a run with its copy in the class, and
    the class ends where a lag could pass two thirds of it.
    """
    lag = 1
    while periods * lag <= n:
        turn = least // periods
        near = [max(least - q, (periods - 1) * q) for q in (turn, turn + 1) if q >= lag]
        gram = min([max(least - lag, (periods - 1) * lag), *near])
        end = -(-2 * gram // 3)
        yield gram, lag, end
        lag = end


def no_gram_twice(ids: np.ndarray, gram: int) -> bool:
    """True when hashes prove that no `gram` words recur; equal grams always hash alike."""
    if len(ids) <= gram:
        return True
    step = np.uint64(0x9E3779B97F4A7C15)
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    size = 1
    while 2 * size <= gram:
        h = h[:-size] * step + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    if size < gram:
        h = h[: len(ids) - gram + 1] * step + h[gram - size :]
    h = np.sort(h)
    return not (h[1:] == h[:-1]).any()


def gram_names(ids: np.ndarray) -> Iterator[np.ndarray]:
    """Exact numbers of the grams of 1, 2, 4, ... words: equal if and only if the grams are."""
    names, size = ids.astype(np.int64), 1
    while True:
        yield names
        if 2 * size > len(ids):
            return
        # both halves are numbers below len(ids), so a pair fits one long
        names = np.unique(names[:-size] * len(ids) + names[size:], return_inverse=True)[1].astype(np.int64)
        size *= 2


def stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest [left, right) around `at` whose words equal those `lag` further on."""
    n, right, step = len(ids) - lag, at, 32
    while right < n:
        last = min(n, right + step)
        differs = ids[right:last] != ids[right + lag : last + lag]
        if differs.any():
            right += int(differs.argmax())
            break
        right, step = last, 2 * step
    left, step = at, 32
    while left > 0:
        first = max(0, left - step)
        differs = ids[first:left] != ids[first + lag : left + lag]
        if differs.any():
            left -= int(differs[::-1].argmax())
            break
        left, step = first, 2 * step
    return left, right


def find_runs(ids: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, smallest period) of numbered words, by start, then period."""
    n, runs, extents = len(ids), [], set()
    if n < least:
        return runs
    doubling, names, size = None, ids, 1
    for gram, first, end in lag_classes(n, least, periods):
        if gram >= n:
            break
        if doubling is None:
            if no_gram_twice(ids, gram):
                return runs
            doubling = gram_names(ids)
            names = next(doubling)
        while 2 * size <= gram:
            names, size = next(doubling), 2 * size
        grams = names[: n - gram + 1] * n + names[gram - size : n - size + 1]
        order = np.argsort(grams, kind="stable")
        here, there = order[:-1], order[1:]
        again = grams[here] == grams[there]
        if not again.any():
            break  # nor do longer grams recur
        lags = there - here
        seeds = np.flatnonzero(again & (lags >= first) & (lags < end))
        seeds = seeds[np.lexsort((here[seeds], lags[seeds]))]
        covered: dict[int, int] = {}
        for at, lag in zip(here[seeds].tolist(), lags[seeds].tolist()):
            if at < covered.get(lag, 0):
                continue
            left, right = stretch(ids, at, lag)
            covered[lag] = right
            length = right - left + lag
            # the same extent with a smaller period was found at a smaller lag
            if length >= max(least, periods * lag) and (left, length) not in extents:
                extents.add((left, length))
                runs.append((left, length, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of `n` words no run contains after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def runs_of_text(raw: bytes, least: int, periods: int) -> tuple[int, list[tuple[int, int, int]], str]:
    """Number of words, runs and the collapsed text; ASCII white space parts words."""
    words = raw.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    runs = find_runs(ids, least, periods)
    if runs:
        words = [words[i] for i in np.flatnonzero(kept_words(len(ids), runs)).tolist()]
    return len(ids), runs, b" ".join(words).decode("utf-8", "replace")


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per document (`SCHEMA`): its words, every periodic run, and the text without repeats.

    A run is a stretch of words of smallest period q, of max(`least`, `periods` * q) words
    or more, that neither neighbour extends; start and length count words. `collapsed` has
    the words that no run contains after its first period, joined by one space. `periods`
    is 3 at least. Null and empty texts have no word, no run and an empty result. Repeated
    rows each get a row, ids may be null, other columns are not read; an empty table gives
    no rows. A text is one task's work, about n log n for n words.
    """
    if periods < 3 or least < periods:
        raise ValueError("runs of fewer than three periods are not searched")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                found = [runs_of_text(raw, least, periods) for raw in part.column(1).cast(pa.binary()).to_pylist()]
                runs = [[dict(zip(("start", "length", "period"), r)) for r in f[1]] for f in found]
                columns = [part.column(0), pa.array([f[0] for f in found]), pa.array(runs, _RUN_TYPE)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([f[2] for f in found], pa.string())], schema=_ARROW)

    return docs.select(F.col(ID).cast("long").alias(ID), whole_text().alias("text")).mapInArrow(run, SCHEMA)


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """Columns (doc_id, text): every tenth document, by the CRC-32 of its id, ends periodically.

    With h the CRC-32 of the id's decimal text and g = floor(h / 10), words from a = g mod n
    on repeat with period 1 + floor((n - a) / (3 + g mod 8)) where h mod 10 is 0. Other texts
    stay as they are, as do those without a word and rows without an id.
    """
    h = F.crc32(F.col(ID).cast("long").cast("string"))
    words = F.filter(F.split(whole_text(), "[ \t\n\x0b\f\r]+"), lambda w: w != "")
    rows = docs.select(F.col(ID).cast("long").alias(ID), whole_text().alias("text"), h.alias("h"))
    planted = (F.col("h") % 10 == 0) & (F.trim(F.translate("text", "\t\n\x0b\f\r", "     ")) != "")
    rows = rows.select(ID, "text", F.floor(F.col("h") / 10).alias("g"), F.coalesce(planted, F.lit(False)).alias("p"))
    other = rows.where(~F.col("p")).select(ID, "text")
    chosen = rows.where("p").select(ID, "g", words.alias("w")).withColumn("n", F.size("w").cast("long"))
    chosen = chosen.withColumn("a", F.expr("g % n"))
    chosen = chosen.withColumn("period", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("transform(sequence(0L, n - 1), i -> get(w, int(if(i < a, i, a + (i - a) % period))))")
    return other.unionByName(chosen.select(ID, F.array_join(tail, " ").alias("text")))


def run_digests(found: DataFrame) -> DataFrame:
    """The digests of `periodic_runs`: the run of greatest length / period, and SHA-256 sums."""
    # exact: lengths and periods are word counts, so the products fit a long
    best = F.expr(
        "aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    rows = found.select("*", best.alias("best"))
    return rows.select(
        ID,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
