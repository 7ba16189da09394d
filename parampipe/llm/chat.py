"""Chat formatting: every dialogue once from the view of each of its speakers.

The viewing speaker's turns become the assistant's and are learned; the others
are users who keep their names; system turns stay system turns. Texts are laid
out by running sums over ranges of the ordered rows, so a dialogue of any length
is spread like many short ones. Functions of Spark SQL only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parampipe.llm.common import materialize

# Marks of the chat format.
OPEN, CLOSE, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
SYSTEM_ROLES = ("system",)
NOBODY = "unknown"

# Characters of a dialogue's text in one output row.
CHUNK = 1 << 16
# monotonically_increasing_id keeps the partition in its upper 31 bits
_ROW_BITS = 33

VIEW = ["conv_id", "perspective"]


def header(speaker: Column, perspective: Column) -> Column:
    """Opening line of a turn, as `perspective` sees it."""
    name = (
        F.when(speaker.isin(*SYSTEM_ROLES), speaker)
        .when(speaker == perspective, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), speaker))
    )
    return F.concat(F.lit(OPEN), name, F.lit(NEWLINE))


def messages(turns: DataFrame) -> DataFrame:
    """One row per turn and view, with its place in the rendered dialogue.

    Columns conv_id, perspective, turn, speaker, piece (the rendered turn), start
    (characters before it), learned (boolean), and learn_start and learn_stop
    (the content and its closing mark, null where nothing is learned).

    Turns are ordered by turn (null last), speaker and text; rows that tie in all
    are rendered one after the other. A null role is the speaker ``unknown``, a
    null text is empty, rows without conv_id are one dialogue. A dialogue of
    system turns only has no speaker and so no view; an empty table no rows.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"),
    )
    speakers = rows.where(~F.col("speaker").isin(*SYSTEM_ROLES)).select(
        F.col("conv_id").alias("of_conv"), F.col("speaker").alias("perspective")
    ).distinct()
    views = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")
    learned = F.col("speaker") == F.col("perspective")
    opening = header(F.col("speaker"), F.col("perspective"))
    views = views.select(
        *VIEW,
        "turn",
        "speaker",
        "content",
        learned.alias("learned"),
        F.char_length(opening).alias("opening"),
        F.concat(opening, F.col("content"), F.lit(CLOSE + NEWLINE)).alias("piece"),
    )
    order = [F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("content")]
    ranged = (
        views.repartitionByRange(*VIEW, *order)
        .sortWithinPartitions(*VIEW, *order)
        .drop("content")
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("size", F.char_length("piece").cast("long"))
    )
    laid = materialize(ranged, "views").withColumn("part", F.shiftright("row", _ROW_BITS))
    # places inside a partition, and what its earlier partitions hold of the dialogue
    inside = W.partitionBy(*VIEW, "part").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*VIEW).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = laid.groupBy(*VIEW, "part").agg(F.sum("size").alias("size"))
    parts = parts.select(*VIEW, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    placed = laid.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    start = F.col("inside") + F.col("offset")
    content_start = start + F.col("opening")
    content_stop = start + F.col("size") - F.lit(len(NEWLINE))
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*VIEW, "part"]]
    return (
        placed.alias("m")
        .join(parts.alias("o"), on)
        .select(
            *[F.col(f"m.{c}") for c in VIEW],
            "turn",
            "speaker",
            "row",
            "piece",
            start.alias("start"),
            "learned",
            F.when(F.col("learned"), content_start).alias("learn_start"),
            F.when(F.col("learned"), content_stop).alias("learn_stop"),
        )
    )


def dialogues(placed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rendered texts: conv_id, perspective, chunk, n_messages, text, spans.

    A dialogue is one row, or several in order (`chunk` from 0) where it is longer
    than `chunk` characters; a turn is never cut. `spans` are the learned ranges,
    in characters from the start of the dialogue.
    """
    span = F.when(F.col("learned"), F.struct(F.col("learn_start").alias("start"), F.col("learn_stop").alias("stop")))
    grouped = placed.groupBy(*VIEW, F.floor(F.col("start") / chunk).cast("long").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.array_sort(F.collect_list(F.struct("row", "piece", span.alias("span")))).alias("m"),
    )
    return grouped.select(
        *VIEW,
        "chunk",
        "n_messages",
        F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("text"),
        F.array_compact(F.transform("m", lambda x: x["span"])).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """Spans as ``start-stop`` joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return F.array_join(one, ",")
