"""Checks and plans over a corpus of query templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.functions import templates as T
from parampipe.functions.naming import describe_case
from parampipe.operators.cases import case_params, expand_cases
from parampipe.operators.ledger import FAIL, OK
from parampipe.operators.numbering import with_ordinal


def placeholder_summary(corpus: DataFrame, text: str = "text") -> DataFrame:
    """Number of templates using each placeholder name."""
    names = corpus.select(F.explode(T.placeholder_names(F.col(text))).alias("param"))
    return names.groupBy("param").agg(F.count(F.lit(1)).alias("templates"))


def lint_report(corpus: DataFrame, given: list[str], text: str = "text") -> DataFrame:
    """Status and findings of every template, given the names of the set parameters.

    Names are found once per text: each later step uses the column of the one
    before.
    """
    known = F.array(*[F.lit(g) for g in given]).cast("array<string>")
    rest = [c for c in corpus.columns if c != text]
    named = corpus.select(*rest, text, T.placeholder_names(F.col(text)).alias("_used"))
    checked = named.withColumn("_missing", F.array_except("_used", known))
    found = checked.withColumn("issues", T.lint_issues(F.col(text), F.col("_missing")))
    return found.select(
        *rest,
        F.when(F.col("issues") == "", OK).otherwise(FAIL).alias("status"),
        "issues",
        F.array_join("_used", ",").alias("params_used"),
        F.array_join("_missing", ",").alias("params_missing"),
    )


def gate(report: DataFrame) -> bool:
    """True when any template failed."""
    return bool(report.agg(F.bool_or(F.col("status") == FAIL)).first()[0])


def with_preview(df: DataFrame, text: str, values: Column, name: str = "preview") -> DataFrame:
    """Add the lines of `text` around those that hold one of `values`."""
    lines = df.withColumn("_lines", T.text_lines(F.col(text)))
    hits = lines.withColumn("_hits", T.hit_lines(F.col("_lines"), values))
    return hits.withColumn(name, T.lines_around(F.col("_lines"), F.col("_hits"))).drop(
        "_lines", "_hits"
    )


def render_plan(
    corpus: DataFrame, file_name: str, specs: dict[str, Column], text: str = "text"
) -> DataFrame:
    """Rendered statement of every template and case, with its header comment
    and a preview of the lines holding a value.

    Cases are generated inside the row of their template; nothing is joined.
    """
    names = sorted(specs)
    cut = corpus.select(
        *[c for c in corpus.columns if c != text],
        T.literal_pieces(F.col(text)).alias("_literals"),
        T.placeholder_pieces(F.col(text)).alias("_marks"),
    )
    cased = expand_cases(cut, specs).withColumn("_params", case_params(names))
    rendered = T.render(F.col("_literals"), F.col("_marks"), F.col("_params"))
    bodies = cased.withColumn("_body", T.strip_end(rendered))
    previewed = with_preview(bodies, "_body", F.map_values("_params"))
    return previewed.select(
        *[c for c in corpus.columns if c != text],
        describe_case(F.col("_params")).alias("params"),
        F.concat(T.plan_header(F.col(file_name), F.col("_params")), "_body").alias("rendered"),
        "preview",
    )


def file_order(files: DataFrame, name: str, position: str, group: list[str] | None = None) -> DataFrame:
    """Run order of template files.

    With a numeric prefix anywhere in the group: by prefix, files without one
    last; otherwise by name ignoring case.
    """
    prefix = F.nullif(F.regexp_extract(name, r"(?i)^(\d+)_.*\.sql$", 1), F.lit("")).cast("bigint")
    keyed = files.withColumn("_prefix", prefix)
    by = group or []
    flags = keyed.groupBy(*by).agg((F.count("_prefix") > 0).alias("_prefixed"))
    joined = keyed.join(flags, by) if by else keyed.withColumn(
        "_prefixed", keyed.agg(F.count("_prefix") > 0).scalar()
    )
    first = F.when(F.col("_prefixed"), F.col("_prefix"))
    second = F.when(F.col("_prefixed"), F.col(name)).otherwise(F.lower(name))
    ordered = joined.withColumn("_first", first).withColumn("_second", second)
    return with_ordinal(
        ordered, [F.col("_first").asc_nulls_last(), F.col("_second"), F.col(name)], position, group
    ).drop("_prefix", "_prefixed", "_first", "_second")
