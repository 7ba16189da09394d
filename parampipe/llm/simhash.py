"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

A fingerprint has bit k set when over half of the text's shingle hashes have it.
Fingerprints that differ in at most `radius` bits are linked; components of the
links are the groups. Every pair of distinct fingerprints is either compared or
proven apart: two words differ in at least as many bits as their population
counts do, so fingerprints lie in tiles of equal count and only tiles whose
counts are within the radius meet.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ID, connected_components, fresh, ship_with_tasks, text_hash, whole_text
from parampipe.session import materialize

ship_with_tasks(__name__)

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42

# Fingerprints in a tile: 8 bytes each on either side of a comparison.
TILE = 16_384
# Rows of one tile that meet the whole other tile in one numpy call.
ROWS = 32


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the `words`-word shingles, repeats included; 0 without a word.

    Only A-Z are lower-cased and only ASCII white space parts words, which is what
    the byte-string methods do.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist())
        ],
        dtype="<u8",
    )
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), 65_536):
        block = hashes[first : first + 65_536]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return of(text)


def tile_forest(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links that join all components of the tile pair: one per merge, never all pairs."""
    a, b = left.view(np.uint64), right.view(np.uint64)
    # labels of the nodes: `a` first, then `b`; in a tile with itself they coincide
    label = np.arange(len(a) + (0 if same else len(b)))
    of_b = 0 if same else len(a)
    links = []
    for first in range(0, len(a), ROWS):
        block = a[first : first + ROWS]
        near = np.bitwise_count(block[:, None] ^ b[None, :]) <= radius
        rows, columns = np.nonzero(near)
        if same:
            later = columns > rows + first
            rows, columns = rows[later], columns[later]
        if not len(rows):
            continue
        apart = label[rows + first] != label[columns + of_b]
        for r in np.unique(rows[apart]):
            hits = columns[apart & (rows == r)]
            own = label[r + first]
            other, where = np.unique(label[hits + of_b], return_index=True)
            new = other != own
            if new.any():
                links.extend((int(left[r + first]), int(right[hits[w]])) for w in where[new])
                label[np.isin(label, other)] = own
    return links


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Columns (a, b): links that span every component of the distinct values in `fp`."""
    counted = fingerprints.select("fp", F.bit_count("fp").alias("ones"))
    sizes = counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("ones", F.ceil(F.col("n") / tile).cast("int").alias("chunks"))
    # at most 65 rows: one for each population count
    tiles = (
        counted.join(F.broadcast(sizes), "ones")
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .groupBy("ones", "chunk")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = materialize(tiles, "tiles")
    names = tiles.select("ones", "chunk")
    reach = names.select(
        F.col("ones").alias("l_ones"),
        F.col("chunk").alias("l_chunk"),
        F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)).alias("ones"),
    )
    pairs = reach.join(names, "ones").where("ones > l_ones or chunk >= l_chunk")
    pairs = pairs.select("l_ones", "l_chunk", F.col("ones").alias("r_ones"), F.col("chunk").alias("r_chunk"))

    keys = ["l_ones", "l_chunk", "r_ones", "r_chunk"]

    def side(s: str) -> DataFrame:
        on = [F.col(f"p.{s}_ones") == F.col("t.ones"), F.col(f"p.{s}_chunk") == F.col("t.chunk")]
        joined = pairs.alias("p").join(tiles.alias("t"), on)
        # own column ids on either side: both are made of the same tables
        return joined.select(*[F.col(f"p.{k}").alias(f"{s}_side_{k}") for k in keys], "t.fps")

    def grouped(s: str):
        return side(s).groupBy(*[f"{s}_side_{k}" for k in keys])

    def compare(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        same = key[:2] == key[2:]
        sides = (np.asarray(s["fps"].iloc[0], dtype=np.int64) for s in (left, right))
        return pd.DataFrame(tile_forest(*sides, same, radius), columns=["a", "b"], dtype="int64")

    return grouped("l").cogroup(grouped("r")).applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, text_hash, fp (long), component (a fingerprint), component_id.

    component_id is the least doc_id of the group. Null and empty texts, and texts
    of white space only, have fingerprint 0 and link like any other. Repeated rows
    each get a row. Rows without doc_id belong to their group but give it no id; a
    group of such rows only has a null component_id. Other columns are not read;
    an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(ID).cast("long").alias(ID),
        text_hash().alias("text_hash"),
        fingerprint_column(whole_text(), words).alias("fp"),
    )
    rows = materialize(rows, "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min(ID).alias("least")), "distinct")
    links = fingerprint_links(distinct, radius)
    roots = connected_components(links, "simhash")
    known = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("component")
    )
    groups = known.groupBy("component").agg(F.min("least").alias("component_id"))
    members = materialize(known.join(groups, "component").select("fp", "component", "component_id"), "members")
    return rows.join(members, "fp").select(ID, "text_hash", "fp", "component", "component_id")


def hex_digits(value: Column) -> Column:
    """16 lower-case hex digits of a long, read as unsigned."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents that stand for their group, with all columns of `docs`.

    The row with the least (doc_id, text hash) stays, ids before nulls; of rows
    equal in both, one.
    """
    groups = near_duplicates(docs, words, radius)
    order = F.struct(F.col(ID).isNull().alias("n"), F.col(ID).alias("i"), F.col("text_hash").alias("h"))
    first = groups.groupBy("component").agg(F.min(order).alias("k"))
    copies = groups.groupBy(ID, "text_hash").agg(F.count(F.lit(1)).alias("n"))
    key, mark, many = fresh(docs, "_key"), fresh(docs, "_mark"), fresh(docs, "_many")
    stay = first.select(F.col("k.i").alias(key), F.col("k.h").alias(mark))
    stay = stay.join(copies, stay[key].eqNullSafe(copies[ID]) & (stay[mark] == copies.text_hash))
    stay = materialize(stay.select(key, mark, (F.col("n") > 1).alias(many)), "stay")
    hashed = fresh(docs, "_hash")
    rows = docs.withColumn(hashed, text_hash())
    found = rows.join(stay, rows[ID].cast("long").eqNullSafe(stay[key]) & (rows[hashed] == stay[mark]))
    once = found.where(~F.col(many)).select(*docs.columns)
    again = found.where(F.col(many)).dropDuplicates([key, mark]).select(*docs.columns)
    # repeated rows are rare: the second branch costs a scan only where there are any
    return once if stay.where(many).isEmpty() else once.unionByName(again)
