"""From raw documents to token ids: quality rules, line dedup, near-duplicates, mix, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of `docs`. A stage reads what its predecessor wrote.

For every stage: null ids and null columns are values like any other, null texts count
as empty, texts are never cut, columns beyond those of documents pass through, and an
empty table stays empty. What else a stage makes of odd rows is in its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.llm import bpe, lines, mixing, quality, simhash
from parampipe.llm.queries import RANKS, SOURCE_SHARES
from parampipe.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line model keep.

    Empty texts and texts of fewer than 50 words go. Repeated rows are judged alike.
    Labels without an id or a quality are not learnt from; of several labels of an id
    the least counts.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_on_sample(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat others; `n_chars` follows the text.

    No row goes: a text whose lines all go is empty. Of like lines that of the least id
    stays, of rows that share an id, or have none, one of them.
    """
    left = lines.dedup_lines(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the least id, ids before none.

    Texts without a word have one fingerprint, so one of them stays. Of equal rows one stays.
    """
    return simhash.keep_one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that holds the target weights.

    Sources without a share, the null source among them, have one share together.
    """
    return mixing.in_mixed_order(docs, SOURCE_SHARES)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place in the mix, number of tokens, digests of the ids and the decoded bytes, per document.

    The place depends on the documents alone, not on the files they were read from, so it
    is that of the stage before. An empty text has no token. Repeated rows share a place.
    """
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    placed = mixing.with_position(docs.select("doc_id", "text", "source"), SOURCE_SHARES)
    return bpe.digests(placed, ranks, public_tokenizers.PATTERN, keep=("position",))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# SQL cannot express the line model, MinHash components or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
