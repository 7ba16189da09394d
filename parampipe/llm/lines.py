"""Fuzzy line deduplication by MinHash.

Equal lines are one line first. Every different line gets a signature over the
hashes of its character shingles; bands of the signature name the buckets in
which lines meet their bucket's first line; a sketch of each line's shingles rules out
most pairs that cannot be similar while they are joined; exact Jaccard similarity decides
who is linked; of each component of links one line stays, the first in document order.

Signatures, the buckets' lines, sketches and similarities are worked out by numpy in tasks:
with SQL functions, a row for every shingle and an aggregate for every minimum, 24 minima
alone took 336 CPU seconds a GB, and a row for every band key, grouped and joined, 150.
All else is SQL functions.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ID, connected_components, fresh, ship_with_tasks, text_hash, whole_text
from parampipe.session import discard, materialize, release_shuffles

ship_with_tasks(__name__)

# UTF-16 units of a shingle, and the least similarity of a link.
SHINGLE = 5
SIMILARITY = 0.8
# 20 bands of 6 minima: two lines at the threshold share a band with probability
# 1 - (1 - 0.8 ** 6) ** 20 = 0.998, at 0.9 with more than 0.9999999, at 0.2 with 0.001.
BANDS, ROWS = 20, 6
# Band keys that a task holds at a time, and those of one part of all keys.
PAIRS, PART = 1 << 18, 1 << 18
# Lines of a bucket up to which an alone line meets every other one.
MEET = 512
# Shingles hashed at a time: what a processor's cache holds.
UNITS = 1 << 17
# 64-bit words of a line's sketch.
SKETCH = [f"w{k}" for k in range(8)]
# Hash bits that tell a line's shingles apart in its sketch, below the line's number.
_SKETCH_BITS = 46

_SPACE = " \t\x0b\x0c\r"
_POSITIONS = 1 << 32


def _multipliers(n: int) -> list[int]:
    """Fixed odd 32-bit constants."""
    draw = random.Random(20)
    return [draw.getrandbits(32) | 1 for _ in range(n)]


def _different(values: np.ndarray) -> np.ndarray:
    """The different values in order; `values` are sorted in place. `np.unique` would put
    them into a table first, which takes many times as long."""
    values.sort()
    keep = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def _shingles(raw: bytes) -> np.ndarray:
    """The 64-bit hashes of the shingles at all places of some lines, of those too that run
    on into the next line."""
    units = np.frombuffer(raw, dtype=np.uint16).astype(np.uint64)
    units += np.uint64(1)
    n = len(units) - SHINGLE + 1
    h = units[:n].copy()
    for j in range(1, SHINGLE):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += units[j : n + j]
    return _mixed(h)


def _own_shingles(raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all lines' own shingles, line by line, and how many each line has."""
    counts = sizes - (SHINGLE - 1)
    at = np.arange(counts.sum()) + np.repeat(np.arange(len(sizes)) * (SHINGLE - 1), counts)
    return _shingles(raw)[at], counts


def _small(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The rows of `batches`, a few at a time: a worker keeps the memory its largest step took."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        # else Arrow holds what a batch took, beside the next one
        pa.default_memory_pool().release_unused()


def similar_pairs(a: list[str], b: list[str], similarity: float) -> np.ndarray:
    """If the lines of `a` are similar to those beside them in `b`, by exact Jaccard similarity."""
    # a line shorter than a shingle is like none but its equals
    verdicts = np.array([x == y for x, y in zip(a, b)], dtype=bool)
    whole = np.array([i for i, pair in enumerate(zip(a, b)) if min(map(_n_units, pair)) >= SHINGLE], dtype=np.int64)
    for at, raw, sizes in _in_parts([line for i in whole for line in (a[i], b[i])], 64, 2):
        hashes, counts = _own_shingles(raw, sizes)
        # pair, hash and side as one number
        pairs = len(sizes) // 2
        high = np.uint64(64 - max(1, (pairs - 1).bit_length()))
        line = np.repeat(np.arange(len(sizes), dtype=np.uint64), counts)
        own = (line >> np.uint64(1) << high) | (hashes >> (np.uint64(65) - high) << np.uint64(1)) | (line & np.uint64(1))
        own = _different(own)
        common = own[1:][own[1:] ^ own[:-1] == 1]
        total, common = (np.bincount((x >> high).astype(np.int64), minlength=pairs) for x in (own, common))
        verdicts[whole[at.start // 2 : at.stop // 2]] = common >= (total - common) * similarity
    return verdicts


def _n_units(line: str) -> int:
    return len(line) if line.isascii() else len(line.encode("utf-16-le", "surrogatepass")) // 2


def judge_pairs(pairs: DataFrame, similarity: float) -> DataFrame:
    """Columns (lid, first, similar) from (lid, first, line_a, line_b): exact Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            verdicts = similar_pairs(batch.column(2).to_pylist(), batch.column(3).to_pylist(), similarity)
            columns = [batch.column(0), batch.column(1), pa.array(verdicts)]
            yield pa.RecordBatch.from_arrays(columns, names=["lid", "first", "similar"])

    return pairs.select("lid", "first", "line_a", "line_b").mapInArrow(run, "lid long, first long, similar boolean")


def different_lines(docs: DataFrame) -> DataFrame:
    """Columns (lid, line, mark, owner, pos): every different line that is not blank, its
    hash, and where it is first: in the document of the least doc_id, at its first position."""
    exploded = docs.select(F.col(ID).cast("long").alias(ID), F.posexplode(F.split(whole_text(), "\n")).alias("pos", "line"))
    place = F.col(ID).cast("decimal(20,0)") * F.lit(_POSITIONS).cast("decimal(11,0)") + F.col("pos").cast("decimal(10,0)")
    firsts = exploded.where(~blank("line")).groupBy("line").agg(F.min(place).alias("place"), F.min("pos").alias("any"))
    pos = F.expr(f"pmod(place, cast({_POSITIONS} as decimal(11,0)))")
    return firsts.select(
        F.monotonically_increasing_id().alias("lid"),
        "line",
        F.xxhash64("line").alias("mark"),
        F.expr(f"cast((place - pmod(place, cast({_POSITIONS} as decimal(11,0)))) / {_POSITIONS} as bigint)").alias("owner"),
        F.coalesce(pos.cast("int"), F.col("any")).alias("pos"),
    )


def blank(line: str | Column) -> Column:
    return F.btrim(line if isinstance(line, Column) else F.col(line), F.lit(_SPACE)) == ""


def band_keys(lines: list[str]) -> np.ndarray:
    """One row of `BANDS` keys for every line; lines have a shingle's length at least."""
    minima = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint32)
    for at, raw, sizes in _in_parts(lines):
        _minima(raw, sizes, minima[:, at])
    keys = np.empty((len(lines), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band, dtype=np.uint64)
        for row in minima[band * ROWS : (band + 1) * ROWS]:
            key = _mixed((key ^ row) * np.uint64(0x9E3779B97F4A7C15))
        keys[:, band] = key
    return keys.view(np.int64)


def _in_parts(lines: list[str], least: int = 1, together: int = 1) -> Iterator[tuple[slice, bytes, np.ndarray]]:
    """The lines' UTF-16 units and sizes, `UNITS` units at a time, where a line counts for
    `least` or more. Lines that stand `together` are never parted."""
    raw = [line.encode("utf-16-le", "surrogatepass") for line in lines]
    sizes = np.array([len(r) // 2 for r in raw])
    first, ends = 0, np.cumsum(np.maximum(sizes, least))
    while first < len(lines):
        done = ends[first - 1] if first else 0
        last = int(np.searchsorted(ends, done + UNITS, side="right")) // together * together
        last = max(first + together, last)
        yield slice(first, last), b"".join(raw[first:last]), sizes[first:last]
        first = last


def line_sketches(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of different shingles of every line, and one row of words whose bits
    say if the number of them that the hash deals to the bit is odd; lines have a
    shingle's length at least.

    A shingle that only one of two lines has turns one bit, so the sketches of two lines
    never differ in more bits than the lines in shingles.
    """
    bits = 64 * len(SKETCH)
    counts = np.empty(len(lines), dtype=np.int64)
    words = np.empty((len(lines), len(SKETCH)), dtype=np.int64)
    for at, raw, sizes in _in_parts(lines, 128):
        own, shingles = _own_shingles(raw, sizes)
        line = np.repeat(np.arange(len(sizes), dtype=np.uint64), shingles)
        own = _different((line << np.uint64(_SKETCH_BITS)) | (own >> np.uint64(64 - _SKETCH_BITS)))
        line = (own >> np.uint64(_SKETCH_BITS)).astype(np.int64)
        bit = line * bits + (own % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(bit, minlength=len(sizes) * bits) & 1).astype(np.uint8)
        counts[at] = np.bincount(line, minlength=len(sizes))
        words[at] = np.packbits(odd.reshape(-1, bits), axis=1).view(np.int64)
    return counts, words


def _minima(raw: bytes, sizes: np.ndarray, out: np.ndarray) -> None:
    """The least value of every hash function over the shingles of every line."""
    ends = np.cumsum(sizes)
    hashes = np.empty(ends[-1], dtype=np.uint32)
    hashes[: 1 - SHINGLE] = _shingles(raw) >> np.uint64(32)
    # the last shingle of a line again, for those that run on into the next line
    for j in range(1, SHINGLE):
        hashes[ends - j] = hashes[ends - SHINGLE]
    values = np.empty_like(hashes)
    for k, factor in enumerate(_multipliers(len(out))):
        np.multiply(hashes, np.uint32(factor), out=values)
        np.minimum.reduceat(values, ends - sizes, out=out[k])


def _mixed(h: np.ndarray) -> np.ndarray:
    """Mixes `h` in place."""
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def band_parts(lines: DataFrame, parts: int) -> DataFrame:
    """Columns (part, keys, lids): the band keys of every line that has a whole shingle and
    the lines' numbers, as bytes, dealt out by key; a row for each part and `PAIRS` of them.

    A shorter line is like none but its equals, and equal lines are one line here. Where
    more than two lines of a row share a key, two of them stand for the key in its part;
    the others go to any part, with no keys to be compared (`part` below 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _small(batches):
            keys = band_keys(batch.column(1).to_pylist()).view(np.uint64)
            held.append((keys.ravel(), np.repeat(batch.column(0).to_numpy(), BANDS)))
            n += keys.size
            if n >= PAIRS:
                yield _dealt(held, parts)
                held, n = [], 0
        if held:
            yield _dealt(held, parts)

    whole = lines.where(F.octet_length(F.encode("line", "UTF-16BE")) >= 2 * SHINGLE).select("lid", "line")
    return whole.mapInArrow(run, "part long, keys binary, lids binary")


def _dealt(held: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    keys, lids = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys)
    keys, lids = keys[order], lids[order]
    more = np.zeros(len(keys), dtype=bool)
    more[2:] = keys[2:] == keys[:-2]
    rows = []
    if more.any():
        rows.append((-1 - int(lids[0] % parts), keys[more], lids[more]))
        keys, lids = keys[~more], lids[~more]
    width = (1 << 64) // parts + 1
    cuts = np.searchsorted(keys, np.arange(1, parts, dtype=np.uint64) * np.uint64(width) if parts > 1 else keys[:0])
    rows += [(part, k, x) for part, (k, x) in enumerate(zip(np.split(keys, cuts), np.split(lids, cuts))) if len(k)]
    columns = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (1, 2))]
    return pa.RecordBatch.from_arrays(columns, names=["part", "keys", "lids"])


def bucket_lines(parts: DataFrame) -> DataFrame:
    """Columns (key, lid): the lines of every bucket of two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = None, []
        for batch in _small(batches, 64):
            for part, *pair in zip(*(column.to_pylist() for column in batch.columns)):
                pair = tuple(np.frombuffer(x, dtype=np.int64) for x in pair)
                if part < 0:
                    yield _members(*pair)
                    continue
                if part != known and held:
                    yield _shared(held)
                    held = []
                known = part
                held.append(pair)
        if held:
            yield _shared(held)

    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(run, "key long, lid long")


def _shared(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, lids = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys)
    keys = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    np.equal(keys[1:], keys[:-1], out=same[1:-1])
    shared = same[1:] | same[:-1]
    return _members(keys[shared], lids[order[shared]])


def _members(keys: np.ndarray, lids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(lids)], names=["key", "lid"])


def sketched(lines: DataFrame) -> DataFrame:
    """Columns (lid, line, n, w0, w1, ...): the lines with what `line_sketches` says of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            counts, words = line_sketches(batch.column(1).to_pylist())
            columns = [pa.array(np.ascontiguousarray(words[:, k])) for k in range(len(SKETCH))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts), *columns], names=["lid", "line", "n", *SKETCH])

    schema = ", ".join(["lid long, line string, n long", *(f"{w} long" for w in SKETCH)])
    return lines.select("lid", "line").mapInArrow(run, schema)


def may_be_similar(similarity: float) -> Column:
    """False only for lines `_a` and `_b` that are less than `similarity` alike.

    Lines that are as similar differ in (n_a + n_b) * (1 - t) / (1 + t) shingles at most.
    The 1 makes up for shingles of a very long line that a shortened hash takes for one.
    """
    apart = sum(F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in SKETCH)
    return apart <= (F.col("n_a") + F.col("n_b")) * ((1 - similarity) / (1 + similarity)) + 1


def _side(texts: DataFrame, lid: str, side: str, *more: str) -> DataFrame:
    return texts.select(F.col("lid").alias(lid), *[F.col(c).alias(f"{c}_{side}") for c in (*more, "n", *SKETCH)])


def bucket_members(lines: DataFrame) -> DataFrame:
    """Columns (key, lid, first, n): the lines of every bucket of two or more, with its first
    line and its size."""
    spark = lines.sparkSession
    parts = max(1, lines.count() * BANDS // PART)
    members = materialize(bucket_lines(band_parts(lines, parts)), "buckets")
    release_shuffles(spark)
    sizes = members.groupBy("key").agg(F.min("lid").alias("first"), F.count(F.lit(1)).alias("n"))
    found = materialize(members.join(sizes, "key"), "members")
    discard(members)
    return found


def shingle_rows(lines: DataFrame) -> DataFrame:
    """Columns (lid, root, alone, n, h): a row for every different shingle of the lines
    (lid, root, alone, line), with the number of them and the shingle's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            for at, raw, sizes in _in_parts(batch.column(3).to_pylist(), 128):
                own, counts = _own_shingles(raw, sizes)
                each = [_different(x) for x in np.split(own, np.cumsum(counts)[:-1])]
                n = np.array([len(x) for x in each])
                line = pa.array(np.repeat(np.arange(at.start, at.stop), n))
                columns = [batch.column(i).take(line) for i in range(3)]
                columns += [pa.array(np.repeat(n, n)), pa.array(np.concatenate(each).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lid", "root", "alone", "n", "h"])

    return lines.select("lid", "root", "alone", "line").mapInArrow(run, "lid long, root long, alone boolean, n long, h long")


def close_pairs(near: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Columns (lid, first): all pairs of lines of `near` (lid, root, alone) with different
    roots that can reach `similarity` and of which one is alone. None that does is left out.
    `texts` has the sketches.

    With the shingles of all lines in one order, the rare ones first, the first common
    shingle of two similar lines stands early in both: in the larger set among the first
    1 - t of it, in the smaller one among the first 1 - 2t / (1 + t). Lines that share a
    passage differ in rare shingles, so what is in that many of them is seldom early.
    """
    rounding = 1e-6
    each = shingle_rows(near.join(texts.select("lid", "line"), "lid"))
    each = materialize(each, "shingles")
    release_shuffles(near.sparkSession)
    counts = each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counts = materialize(counts, "counts")
    release_shuffles(near.sparkSession)
    # a shingle that only one line has comes before these and needs no row
    order = F.array_sort(F.collect_list(F.struct("c", "h")))
    shared = each.join(counts, "h").groupBy("lid", "root", "alone", "n").agg(order.alias("s"))
    shared = shared.join(texts.select("lid", *SKETCH), "lid")
    at = F.col("n") - F.size("s") + F.col("i")
    placed = shared.select("*", F.posexplode("s").alias("i", "t")).select("lid", "root", "alone", "n", at.alias("i"), "t.h", *SKETCH)

    def early(share: float) -> Column:
        return F.col("i") <= F.col("n") - F.ceil(F.col("n") * share - rounding)

    small = early(2 * similarity / (1 + similarity)).alias("small")
    postings = materialize(placed.where(early(similarity)).select("*", small), "postings")
    discard(each, counts)
    release_shuffles(near.sparkSession)
    a, b = (postings.select("h", *[F.col(c).alias(f"{c}_{x}") for c in ("lid", "root", "alone", "n", "i", "small", *SKETCH)]) for x in "ab")
    common = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    on = (
        (a["h"] == b["h"])
        & (F.struct("n_a", "lid_a") < F.struct("n_b", "lid_b"))
        & (F.col("n_a") >= F.col("n_b") * similarity - rounding)
        & (common >= (F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - rounding)
        & (a["root_a"] != b["root_b"])
        & may_be_similar(similarity)
    )
    a = a.where("small_a")
    met = a.where("alone_a").join(b, on).union(a.where("not alone_a").join(b.where("alone_b"), on))
    return met.select(F.col("lid_b").alias("lid"), F.col("lid_a").alias("first")).distinct()


def similar_lines(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Columns (a, b): links of similar lines that span the groups the buckets show.

    In every bucket the lines meet the first one. Of the components this makes, be it by
    way of other buckets, the one that most lines of a bucket are in is at home there; the
    lines of others are alone, and of any two lines of a bucket that are not joined yet
    one is alone. In a bucket of two lines nothing is left to compare. In one of `MEET`
    lines or fewer an alone line meets all lines of other components; in larger ones, those that can be similar to it (`close_pairs`).
    Joins keep only pairs that the sketches let be similar, which all similar ones are.
    So every similar pair of a bucket is joined, and no bucket is ever held in one place.
    """
    spark = lines.sparkSession
    members = bucket_members(lines)
    release_shuffles(spark)
    texts = materialize(sketched(lines.join(members.select("lid").distinct(), "lid")), "texts", "zstd")
    release_shuffles(spark)
    judged = _judge(members.where("lid <> first"), texts, similarity)
    release_shuffles(spark)
    links = _passed(judged)
    # in a bucket of two lines the one has met the other
    more = members.where("n > 2")
    rooted = materialize(_rooted(more, connected_components(links, "joined")), "rooted")
    discard(members)
    release_shuffles(spark)
    alone = materialize(_alone(rooted), "alone")
    few = alone.where(F.col("n") <= MEET).select("key", F.col("lid").alias("x"), F.col("root").alias("root_x"))
    others = rooted.join(few.select("key").distinct(), "key", "left_semi")
    others = others.select("key", F.col("lid").alias("y"), F.col("root").alias("root_y"))
    met = few.join(_side(texts, "x", "a"), "x").join(others.join(_side(texts, "y", "b"), "y"), "key")
    met = met.where((F.col("root_x") != F.col("root_y")) & may_be_similar(similarity))
    met = met.select(F.greatest("x", "y").alias("lid"), F.least("x", "y").alias("first")).distinct()
    many = alone.where(F.col("n") > MEET)
    if not many.isEmpty():
        near = rooted.join(many.select("key").distinct(), "key", "left_semi").select("lid", "root").distinct()
        lids = many.select("lid", F.lit(True).alias("alone")).distinct()
        near = near.join(lids, "lid", "left").select("lid", "root", F.coalesce("alone", F.lit(False)).alias("alone"))
        near = materialize(near, "near")
        release_shuffles(spark)
        met = met.unionByName(close_pairs(near, texts, similarity)).distinct()
    met = materialize(met.join(judged, ["lid", "first"], "left_anti"), "pairs")
    release_shuffles(spark)
    again = _judge(met, texts, similarity)
    discard(texts, rooted, alone, met)
    release_shuffles(spark)
    return links.union(_passed(again))


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Columns (key, lid, root): the lines of every bucket with their components."""
    roots = roots.select(F.col("node").alias("lid"), "root")
    return members.select("key", "lid").join(roots, "lid", "left").select("key", "lid", F.coalesce("root", "lid").alias("root"))


def _alone(rooted: DataFrame) -> DataFrame:
    """Columns (key, lid, root, n): the lines outside the component that most lines of their
    bucket are in, and the bucket's size. Of two lines not joined one is outside."""
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    most = most.where("parts > 1").select("key", F.col("most.root").alias("home"), "n")
    return rooted.join(most, "key").where("root <> home").select("key", "lid", "root", "n")


def _passed(judged: DataFrame) -> DataFrame:
    return judged.where("similar").select(F.col("lid").alias("a"), F.col("first").alias("b"))


def _judge(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    both = pairs.select("lid", "first").distinct()
    a, b = _side(texts, "lid", "a", "line"), _side(texts, "first", "b", "line")
    near = both.join(a, "lid").join(b, "first").where(may_be_similar(similarity))
    return materialize(judge_pairs(near, similarity), "judged")


def kept_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Columns (owner, pos, mark): doc_id, position and hash of every line that stays."""
    lines = materialize(different_lines(docs), "lines", "zstd")
    release_shuffles(docs.sparkSession)
    roots = connected_components(similar_lines(lines, similarity), "lines")
    places = lines.select("lid", "owner", "pos", "mark")
    place = F.struct(F.col("owner").isNull().alias("n"), "owner", "pos", "lid")
    members = roots.join(places, F.col("node") == F.col("lid"))
    stays = members.groupBy("root").agg(F.min(place).alias("p")).select(F.col("p.lid").alias("stay"))
    gone = roots.join(stays, F.col("node") == F.col("stay"), "left_anti").select(F.col("node").alias("lid"))
    kept = materialize(places.join(gone, "lid", "left_anti").drop("lid"), "kept")
    discard(lines)
    release_shuffles(docs.sparkSession)
    return kept


def _with_kept(rows: DataFrame, key: str, kept: DataFrame, names: list[str]) -> DataFrame:
    """`rows` with the text of the lines that stay, and the counts of lines under `names`.

    `kept` has the positions of each row's lines under the same `key`.
    """
    stay, parts = (fresh(rows, n) for n in ("_stay", "_parts"))
    kept = kept.withColumnsRenamed({"stay": stay, "key": key})
    joined = rows.withColumn(parts, F.split(whole_text(), "\n")).join(kept, key, "left")
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    blanks = F.filter(every, lambda i: blank(F.element_at(F.col(parts), i + 1)))
    order = F.sort_array(F.array_union(F.coalesce(stay, F.array().cast("array<int>")), blanks))
    text = F.array_join(F.transform(order, lambda i: F.element_at(F.col(parts), i + 1)), "\n")
    counted = joined.withColumn(names[0], F.size(parts)).withColumn(names[1], F.size(order))
    return counted.withColumn("text", text).drop(stay, parts, key)


def _claims(rows: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """Columns (key, stay) for rows that share an id: of the rows that have a kept line at
    its place, the one with the least `key` keeps it."""
    own = rows.select(F.col(key).alias("key"), F.col(ID).cast("long").alias("owner"), F.posexplode(F.split(whole_text(), "\n")).alias("pos", "line"))
    own = own.select("key", "owner", "pos", F.xxhash64("line").alias("mark")).alias("o")
    same = (F.col("o.owner").eqNullSafe(F.col("k.owner"))) & (F.col("o.pos") == F.col("k.pos")) & (F.col("o.mark") == F.col("k.mark"))
    held = own.join(kept.alias("k"), same).groupBy("o.owner", "o.pos", "o.mark").agg(F.min("key").alias("key"))
    return held.groupBy("key").agg(F.collect_list("pos").alias("stay"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` with the lines that stay, and the column ``n_lines`` of before
    (under a free name if there is one), ``n_kept`` likewise.

    Texts are parted at ``\\n``. Blank lines stay where they are. Of equal and similar
    lines one stays: that of the document of the least doc_id, at its first position, and
    a document without an id comes last. Of rows that share an id, or have none, one row
    keeps the line. Null texts become empty, as does a text whose lines all go.
    An empty table stays empty; other columns, ``n_chars`` too, stay as they are.
    """
    kept = kept_lines(docs, similarity)
    key, names = fresh(docs, "_key"), [fresh(docs, "n_lines"), fresh(docs, "n_kept")]
    rows = docs.withColumn(key, F.col(ID).cast("long"))
    owners = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    shared = owners.where((F.col("n") > 1) | F.col(key).isNull()).select(F.col(key).alias("shared"))
    shared = materialize(shared, "shared")
    columns = [*docs.columns, *names]
    if shared.isEmpty():
        single = kept.groupBy(F.col("owner").alias("key")).agg(F.collect_list("pos").alias("stay"))
        return _with_kept(rows, key, single, names).select(*columns)
    same = F.col(key).eqNullSafe(F.col("shared"))
    alone = kept.join(shared, kept["owner"].eqNullSafe(F.col("shared")), "left_anti")
    single = alone.groupBy(F.col("owner").alias("key")).agg(F.collect_list("pos").alias("stay"))
    numbered = rows.join(shared, same, "left_semi").withColumn(key, F.monotonically_increasing_id())
    numbered = materialize(numbered, "numbered", "zstd")
    found = _with_kept(rows.join(shared, same, "left_anti"), key, single, names)
    again = _with_kept(numbered, key, _claims(numbered, key, kept), names)
    return found.select(*columns).unionByName(again.select(*columns))
