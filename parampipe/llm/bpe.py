"""Byte-level BPE: encoding and decoding by DuckDB queries inside each partition.

Words are encoded once per batch of new words: a recursive query keeps one row
per token and position, with its neighbour, joins both with the merge table, and contracts
each word's leftmost pair of least rank until no pair is in the table. Decoding
joins the ids with the vocabulary and puts the bytes together by ordered
aggregation. Spark partitions the documents; a task holds one batch of texts,
the words it has met (`KNOWN_WORDS` at most) and the two tables, and leaves the worker
only the words that came again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import sys
import types
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import fresh, ship_with_tasks, whole_text

ship_with_tasks(__name__)

# Words a worker remembers from the latest texts; of those before, also of the tasks it
# ran, it remembers what came more than once. What it forgets is encoded again.
KNOWN_WORDS = 400_000
# Characters of text, words of a query, and ids of a query held at once. In one process
# larger blocks of text took no less time (80 MB of texts: 35 CPU seconds with 2 or 4 million
# characters), and a task has an encoder and a decoder, which share an executor's memory.
TEXT_BLOCK = 2_000_000
WORD_BLOCK = 30_000
ID_BLOCK = 250_000
# A word of more bytes goes through a heap: the same contractions, in n log n steps
# where the recursive query would take n steps of n rows.
LONG_WORD = 256

ENCODE_WORDS = """
WITH RECURSIVE state(w, p, t, next_p, next_t, open) AS (
    SELECT w, p, t, CASE WHEN next_t IS NOT NULL THEN p + 1 END::INTEGER, next_t, true FROM word_bytes
    UNION ALL
    (WITH ranked AS MATERIALIZED (
        SELECT w, p, t, next_p, next_t, rank FROM state
        LEFT JOIN merges ON pair = ((t::BIGINT << 32) | next_t) WHERE open
    ), least AS (
        SELECT w, min((rank::BIGINT << 32) | p) AS key FROM ranked GROUP BY w
    ), hit AS MATERIALIZED (
        SELECT least.w, (key & 4294967295)::INTEGER AS left_p, (key >> 32)::INTEGER AS merged,
            a.next_p AS gone, b.next_p AS after_p, b.next_t AS after_t
        FROM least
        LEFT JOIN ranked AS a ON a.w = least.w AND a.p = (key & 4294967295)
        LEFT JOIN ranked AS b ON b.w = least.w AND b.p = a.next_p
    )
    SELECT r.w, r.p,
        CASE WHEN r.p = left_p THEN merged ELSE r.t END,
        CASE WHEN r.p = left_p THEN after_p ELSE r.next_p END,
        CASE WHEN r.p = left_p THEN after_t WHEN r.next_p = left_p THEN merged ELSE r.next_t END,
        left_p IS NOT NULL
    FROM ranked AS r JOIN hit ON r.w = hit.w WHERE left_p IS NULL OR r.p <> gone)
)
SELECT w, t FROM state WHERE NOT open ORDER BY w, p
"""

# A byte is one character here (Latin-1), as the bytes of a token need not be a text.
DECODE_IDS = """
SELECT d, list_aggregate(list(bytes ORDER BY p), 'string_agg', '') AS decoded
FROM token_ids JOIN vocabulary USING (t) GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of every line of a rank file; read by the driver only."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Vocabulary:
    """Ranks as flat tables: tokens, and every pair of tokens that makes a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        pairs = [
            (a, b, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (a := ranks.get(token[:cut])) is not None
            and (b := ranks.get(token[cut:])) is not None
        ]
        left, right, rank = (np.array(x, dtype=np.int64) for x in zip(*pairs))
        self.pairs = pa.table({"pair": (left << 32) | right, "rank": rank.astype(np.int32)})
        self.tokens = pa.table(
            {
                "t": pa.array(list(ranks.values()), pa.int32()),
                "bytes": [token.decode("latin-1") for token in ranks],
            }
        )
        self.name = hashlib.md5(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
        self.known = np.zeros(max(ranks.values()) + 2, dtype=bool)
        self.known[list(ranks.values())] = True
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    @classmethod
    def of(cls, parts: dict) -> Vocabulary:
        """From the attributes of another one: a broadcast carries plain values only."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def connect(self) -> duckdb.DuckDBPyConnection:
        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for name, table in (("merges", self.pairs), ("vocabulary", self.tokens)):
            con.register("incoming", table)
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            con.unregister("incoming")
        return con


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype="<u4").tobytes()


def contract_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the leftmost pair of least rank first, by a heap over a linked list."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    alive = bytearray([1]) * n
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != middle or (j := after[i]) >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = 0, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = after[i]
    return ids


class Encoder:
    """Encodes texts with one DuckDB connection; `known` maps a word to its packed ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.con = vocabulary, vocabulary.connect()
        self.split = regex.compile(vocabulary.pattern)
        # one store for the worker process: functions sent with tasks have no module to keep it in
        self.store = sys.modules.setdefault("_byte_bpe_words", types.ModuleType("_byte_bpe_words"))
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = getattr(self.store, vocabulary.name, {})
        self.again: set[str] = set()

    def learn(self, words: Iterable[str]) -> None:
        ranks, rest = self.vocabulary.ranks, []
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if (rank := ranks.get(raw)) is not None:
                self.known[word] = packed([rank])
            elif len(raw) > LONG_WORD:
                self.known[word] = packed(contract_long(raw, ranks))
            else:
                rest.append((word, raw))
        for first in range(0, len(rest), WORD_BLOCK):
            block = rest[first : first + WORD_BLOCK]
            lengths = np.array([len(raw) for _, raw in block])
            whole = np.frombuffer(b"".join(raw for _, raw in block), dtype=np.uint8)
            stops = np.cumsum(lengths)
            starts = stops - lengths
            ids = self.vocabulary.of_byte[whole]
            last = np.zeros(len(whole), dtype=bool)
            last[stops - 1] = True
            self.con.register(
                "word_bytes",
                pa.table(
                    {
                        "w": np.repeat(np.arange(len(block), dtype=np.int32), lengths),
                        "p": (np.arange(len(whole)) - np.repeat(starts, lengths)).astype(np.int32),
                        "t": ids,
                        "next_t": pa.array(np.append(ids[1:], ids[:1]), mask=last),
                    }
                ),
            )
            found = self.con.sql(ENCODE_WORDS).to_arrow_table()
            self.con.unregister("word_bytes")
            word_of, ids = found["w"].to_numpy(), found["t"].to_numpy().astype("<u4")
            stops = np.searchsorted(word_of, np.arange(len(block)), side="right") * 4
            flat, start = ids.tobytes(), 0
            for (word, _), stop in zip(block, stops.tolist()):
                self.known[word] = flat[start:stop]
                start = stop

    def blocks(self, text: str) -> Iterator[list[str]]:
        if len(text) <= TEXT_BLOCK:
            yield self.split.findall(text)
            return
        words = (m.group() for m in self.split.finditer(text))
        while block := list(itertools.islice(words, TEXT_BLOCK // 4)):
            yield block

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; `texts` are held as words all at once."""
        pieces = [list(self.blocks(t)) if len(t) <= TEXT_BLOCK else None for t in texts]
        new = set()
        for blocks in pieces:
            for words in blocks or ():
                new.update(words)
        self.ready(new)
        out = []
        for text, blocks in zip(texts, pieces):
            if blocks is not None:
                out.append(b"".join(map(self.known.__getitem__, itertools.chain(*blocks))))
                continue
            parts = []
            for words in self.blocks(text):
                self.ready(set(words))
                parts.append(b"".join(map(self.known.__getitem__, words)))
            self.ready(new)
            out.append(b"".join(parts))
        return out

    def ready(self, words: set[str]) -> None:
        """Put all of `words` into `known`."""
        missing = words.difference(self.known)
        self.again.update(words.difference(missing))
        if len(self.known) + len(missing) > KNOWN_WORDS:
            self.before, self.known, self.again, missing = self.met_again(), {}, set(), words
        again = missing.intersection(self.before)
        self.again.update(again)
        self.known.update((w, self.before[w]) for w in again)
        self.learn(missing.difference(again))

    def met_again(self) -> dict[str, bytes]:
        """The words of `known` that more than one block had: most others never come back."""
        return {w: self.known[w] for w in self.again}

    def close(self) -> None:
        """Leave the worker what later tasks use."""
        setattr(self.store, self.vocabulary.name, self.met_again())
        self.con.close()


def give_back() -> None:
    """Return what Arrow's allocator holds unused; a worker waits for its next task with it otherwise."""
    pa.default_memory_pool().release_unused()


def by_length(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose lengths sum to `most` at most, or one that is longer."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def _append(batch: pa.RecordBatch, name: str, values: list, without: str | None = None) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c != without]
    columns = [*[batch.column(batch.schema.names.index(c)) for c in kept], pa.array(values, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=[*kept, name])


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    name: str = "ids",
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with the binary column `name` (under a free name if there is one): ids as
    little-endian unsigned 32-bit integers.

    Every match of `pattern` is encoded by itself and nothing is read as a special
    token. Null and empty texts have no ids. Rows, repeated ones too, and other
    columns stay as they are; the text column becomes non-null, or goes without `keep_text`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(ranks, pattern)))
    name = fresh(docs, name)
    plain = docs.withColumn(text, whole_text(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary.of(shared.value))
        try:
            for batch in batches:
                texts = batch.column(batch.schema.names.index(text))
                for first, stop in by_length(pc.binary_length(texts).to_pylist(), TEXT_BLOCK):
                    part = batch.slice(first, stop - first)
                    ids = encoder.encode(texts.slice(first, stop - first).to_pylist())
                    yield _append(part, name, ids, None if keep_text else text)
                    give_back()
        finally:
            encoder.close()
            give_back()

    return plain.mapInArrow(run, _with_binary(plain if keep_text else plain.drop(text), name))


def decode(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`rows` with the binary column `name` (under a free name if there is one): the bytes
    of the packed ids in `ids`.

    Null and empty ids give empty bytes. An id that is not in the vocabulary raises.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vars(Vocabulary(ranks, "")))
    name = fresh(rows, name)
    plain = rows.withColumn(ids, F.coalesce(F.col(ids), F.lit(b"")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(shared.value)
        con = vocabulary.connect()
        try:
            for batch in batches:
                column = batch.column(batch.schema.names.index(ids))
                for first, stop in by_length(pc.binary_length(column).to_pylist(), 4 * ID_BLOCK):
                    part = batch.slice(first, stop - first)
                    yield _append(part, name, decoded(con, vocabulary.known, column.slice(first, stop - first).to_pylist()))
                    give_back()
        finally:
            con.close()
            give_back()

    return plain.mapInArrow(run, _with_binary(plain, name))


def decoded(con: duckdb.DuckDBPyConnection, known: np.ndarray, packed_ids: list[bytes]) -> list[bytes]:
    """Bytes of each text; `known` says of every id, and of one above all, if it is a token."""
    out: list[list[bytes]] = [[] for _ in packed_ids]
    counts = [len(p) // 4 for p in packed_ids]
    longest = max(counts, default=0)
    # one text of more ids than a block is put together from several blocks
    for start in range(0, longest, ID_BLOCK):
        pieces = [p[4 * start : 4 * (start + ID_BLOCK)] for p in packed_ids]
        lengths = np.array([len(p) // 4 for p in pieces])
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        unknown = int((~known[np.minimum(flat, len(known) - 1)]).sum())
        if unknown:
            raise ValueError(f"{unknown} ids are not in the vocabulary")
        con.register(
            "token_ids",
            pa.table(
                {
                    "d": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
                    "p": np.arange(len(flat), dtype=np.int64),
                    "t": flat.astype(np.int32),
                }
            ),
        )
        for d, piece in con.sql(DECODE_IDS).fetchall():
            out[d].append(piece.encode("latin-1"))
        con.unregister("token_ids")
    return [b"".join(o) for o in out]


def _with_binary(df: DataFrame, name: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*fields, f"`{name}` binary"])


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of `docs`: doc_id, the columns of `keep`, n_tokens, SHA-256 of the packed ids
    and of the decoded bytes."""
    rows = docs.select("doc_id", *keep, whole_text().alias("text"))
    coded = decode(encode(rows, ranks, pattern, keep_text=False), ranks)
    return coded.select(
        "doc_id",
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
