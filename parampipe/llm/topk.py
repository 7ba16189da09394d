"""Exact top-k by inner product over an impact-ordered index, score at a time.

The index holds blocks of vectors. In a block every dimension's values are cut into
levels; a level is a posting segment with the ids that have a value in its range.
A query gives each segment an impact, the most it can add to a score, and takes the
segments of all dimensions by descending impact. After each round the sums bound
every score from both sides; the search ends when few vectors can still be among
the best, never before that is proven, and those are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parampipe.llm.common import ship_with_tasks
from parampipe.session import materialize

ship_with_tasks(__name__)

SCALE = 256
# Vectors of an index block, queries that meet it at a time, value levels of a
# dimension, rounds between two proofs, and the share of a block that is rescored.
BLOCK = 8_192
QUERY_BLOCK = 512
LEVELS = 64
ROUNDS = 8
RESCORED = 16

_COUNT = 2.0**40
_EXACT = 2**39

INDEX_SCHEMA = (
    "block int, n int, dims int, ids binary, vectors binary, postings binary, "
    "segment_dim binary, segment_low binary, segment_high binary, segment_size binary"
)


def quantise(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) as longs, of doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def takes_part(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    inf = float("inf")

    def odd(x: Column) -> Column:
        d = x.cast("double")
        return d.isNull() | F.isnan(d) | (d == F.lit(inf)) | (d == F.lit(-inf))

    return vector.isNotNull() & ~F.exists(vector, odd)


def build_block(block: int, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS) -> dict:
    """One index row: the vectors, and the postings by dimension and level."""
    n, dims = vectors.shape
    postings, segments = [], []
    for d in range(dims):
        values = vectors[:, d]
        low, high = int(values.min()), int(values.max())
        width = max(1, -(-(high - low + 1) // levels))
        level = (values - low) // width if high - low < 2**62 else np.zeros(n, dtype=np.int64)
        order = np.argsort(level, kind="stable").astype(np.int32)
        for part in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
            postings.append(part)
            segments.append((d, int(values[part].min()), int(values[part].max()), len(part)))
    table = np.array(segments, dtype=np.int64).reshape(-1, 4)
    flat = np.concatenate(postings) if postings else np.zeros(0, dtype=np.int32)
    return {
        "block": block,
        "n": n,
        "dims": dims,
        "ids": ids.astype(np.int64).tobytes(),
        "vectors": np.ascontiguousarray(vectors, dtype=np.int64).tobytes(),
        "postings": flat.tobytes(),
        **{
            name: np.ascontiguousarray(table[:, i]).tobytes()
            for i, name in enumerate(["segment_dim", "segment_low", "segment_high", "segment_size"])
        },
    }


class Block:
    """An index row, opened for search."""

    def __init__(self, row):
        self.n, self.dims = int(row.n), int(row.dims)
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.vectors = np.frombuffer(row.vectors, dtype=np.int64).reshape(self.n, self.dims)
        self.dim, self.low, self.high, self.size = (
            np.frombuffer(x, dtype=np.int64)
            for x in (row.segment_dim, row.segment_low, row.segment_high, row.segment_size)
        )
        flat = np.frombuffer(row.postings, dtype=np.int32)
        self.lists = np.split(flat, np.cumsum(self.size)[:-1]) if len(self.size) else []
        self.largest = int(np.abs(self.vectors.astype(object)).max()) if self.vectors.size else 0

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best vectors of other ids, best first, then by id."""
        q = np.zeros(self.dims, dtype=np.int64)
        q[: min(len(query), self.dims)] = query[: self.dims]
        other = self.ids != query_id
        bound = 4 * max(1, self.dims) * self.largest * int(np.abs(q.astype(object)).max() if len(q) else 0)
        if bound < _EXACT and self.dims:
            possible = self.possible(q, other, k)
            scores = self.vectors[possible] @ q
        else:
            # sums that do not fit the bounds' arithmetic are taken as whole numbers
            possible = np.flatnonzero(other)
            exact = self.vectors[possible].astype(object) @ q.astype(object) if self.dims else [0] * len(possible)
            scores = np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], dtype=np.int64)
        order = np.lexsort((self.ids[possible], -scores))[:k] if bound < _EXACT else sorted(
            range(len(possible)), key=lambda i: (-int(scores[i]), int(self.ids[possible[i]]))
        )[:k]
        return [(int(self.ids[possible[i]]), int(scores[i])) for i in order]

    def possible(self, q: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
        """Positions that can be among the k best: a superset, proven by the bounds."""
        if int(other.sum()) <= k:
            return np.flatnonzero(other)
        at = q[self.dim]
        most, least = np.maximum(at * self.low, at * self.high), np.minimum(at * self.low, at * self.high)
        floor = np.full(self.dims, np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dim, least)
        slack = np.zeros(self.dims, dtype=np.int64)
        np.maximum.at(slack, self.dim, most - least)
        impact = most - floor[self.dim]
        order = np.argsort(-impact, kind="stable")
        sums = np.zeros(self.n)
        cuts = np.linspace(0, len(order), min(ROUNDS, len(order)) + 1).astype(int)
        alive = np.flatnonzero(other)
        for first, stop in zip(cuts, cuts[1:]):
            taken = order[first:stop]
            where = np.concatenate([self.lists[s] for s in taken.tolist()])
            # impact and number of dimensions seen, in one sum
            sums += np.bincount(where, np.repeat(impact[taken] + _COUNT, self.size[taken]), self.n)
            whole = sums.astype(np.int64)
            seen, partial = whole >> 40, whole & (2**40 - 1)
            next_impact = int(impact[order[stop]]) if stop < len(order) else 0
            upper = partial + next_impact * (self.dims - seen)
            kth_lower = np.partition(partial[other], -k)[-k] - int(slack.sum())
            alive = np.flatnonzero(other & (upper >= kth_lower))
            if len(alive) <= max(k, self.n // RESCORED):
                break
        return alive


def build_index(vectors: DataFrame, block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """Index rows (`INDEX_SCHEMA`) over distinct (id, vector) rows, written once.

    Rows go to blocks by their hash, so blocks are even whatever the ids are.
    """
    blocks = max(1, -(-vectors.count() // block))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dims = max(map(len, rows["vector"]))
        values = np.zeros((len(rows), dims), dtype=np.int64)
        for i, v in enumerate(rows["vector"]):
            values[i, : len(v)] = v
        return pd.DataFrame([build_block(key[0], rows["id"].to_numpy(), values, levels)])

    return materialize(dealt.groupBy("block").applyInPandas(build, INDEX_SCHEMA), "impact")


def search(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Columns (query_id, rank, id, score): the k best of the index for each query row.

    Every block of queries meets every block of the index; k rows of each meeting
    go on, and a window that is cut before the shuffle joins them.
    """
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    numbers = index.select("block")
    dealt = queries.select(
        F.col("id").alias("query_id"),
        F.col("vector").alias("query"),
        F.pmod(F.xxhash64("id", "vector"), F.lit(groups)).cast("int").alias("q_group"),
    )
    group_numbers = dealt.select("q_group").distinct()
    # block and group numbers only: one row for each meeting
    meetings = materialize(
        numbers.withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(
            group_numbers, "q_group"
        ),
        "meetings",
    )
    left = meetings.join(index, "block").select(
        F.col("block").alias("l_block"), F.col("q_group").alias("l_group"), *[c for c in index.columns if c != "block"]
    )
    right = meetings.join(dealt, "q_group").select(
        F.col("block").alias("r_block"), F.col("q_group").alias("r_group"), "query_id", "query"
    )

    def meet(_key: tuple, blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        for row in blocks.itertuples():
            opened = Block(row)
            for query_id, query in zip(asked["query_id"], asked["query"]):
                found.extend((query_id, *hit) for hit in opened.best(query_id, np.asarray(query, dtype=np.int64), k))
        return pd.DataFrame(found, columns=["query_id", "id", "score"], dtype="int64")

    hits = (
        left.groupBy("l_block", "l_group")
        .cogroup(right.groupBy("r_block", "r_group"))
        .applyInPandas(meet, "query_id long, id long, score long")
        .distinct()
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def top_k(table: DataFrame, every: int, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best others of every row whose id is divisible by `every`: query_id, rank, id, score.

    Rows without an id, and vectors that are null or hold null, NaN or infinite
    components, take no part. Repeated rows count once; an id with several vectors
    is one id in the ranking of others but each vector is searched and found, with
    the best score counting. Missing components of shorter vectors are 0. Scores
    beyond the range of a long stay at its end. An empty table gives no rows.
    """
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & takes_part(F.col("vector")))
    rows = materialize(rows.select("id", quantise(F.col("vector")).alias("vector")).distinct(), "vectors")
    return search(rows.where(F.col("id") % every == 0), build_index(rows), k)
