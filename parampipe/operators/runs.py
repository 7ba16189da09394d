"""One extract run: the cases still open, written by case, recorded in the ledger."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions import templates as TP
from parampipe.functions.naming import describe_case
from parampipe.operators import ledger as LG
from parampipe.operators.cases import case_params, case_table, rows_by_case
from parampipe.operators.extract import extract, extract_cases
from parampipe.operators.sinks import case_files, drop_stale_slices, observe_rows, replace_slices, write_parquet
from parampipe.session import materialize
from parampipe.sources.files import read_or_empty

# Values of a parameter up to this many are named in the partition filter.
NAMED_VALUES = 10_000


def open_cases(
    spark: SparkSession,
    name: str,
    template: str,
    params: dict[str, str],
    ledger: DataFrame,
    host: str,
    mode: str = "product",
) -> DataFrame:
    """Cases of a template without a successful attempt of the same text."""
    names = TP.marker_names(TP.to_markers(template))
    text = describe_case(case_params(names)) if names else F.lit("-")
    cases = case_table(spark, params, names, mode).distinct().select(
        *names,
        F.lit(host).alias("host"),
        F.lit(name).alias("sql_file"),
        text.alias("params"),
        F.lit(TP.template_hash(template)).alias("sql_hash"),
    )
    return LG.pending(cases, LG.success_keys(ledger))


def run_extract(
    spark: SparkSession,
    name: str,
    template: str,
    params: dict[str, str],
    path: str,
    ledger_path: str,
    batch_ts: str,
    host: str = "-",
    mode: str = "product",
    scan_per_case: bool = False,
) -> DataFrame:
    """Extract the open cases of a template into `path`.

    All cases are one job. If it fails while it runs, its cases are halved and each
    half is tried by itself, so that a failure is recorded for its own cases only and
    the others are written; what the planner refuses fails for all at once. Each case
    gets a ledger row with its row count, zero for a case without rows, whose older
    output is removed; its time is its share, by rows, of the job that wrote it. A
    template without parameters is one case. Returns the rows added to the ledger.
    """
    names = TP.marker_names(TP.to_markers(template))
    ledger = LG.read_ledger(spark, ledger_path)
    todo = open_cases(spark, name, template, params, ledger, host, mode)
    todo = materialize(todo.withColumn(_AT, F.xxhash64("params")), "cases")
    entries = None
    for attempt in _attempts(spark, template, params, path, todo, names, scan_per_case):
        entry = attempt.select(
            F.lit(batch_ts).alias("batch_ts"),
            *LG.ATTEMPT_KEY,
            "status",
            F.col("row_count").alias("rows"),
            "elapsed_sec",
            F.when(F.col("status") == LG.OK, path).otherwise("").alias("output_file"),
            "error_message",
        )
        entries = entry if entries is None else entries.unionAll(entry)
    if entries is None:
        return spark.createDataFrame([], LG.LEDGER_SCHEMA)
    entries = materialize(LG.format_rows(entries), "ledger")
    LG.append_rows(entries, ledger_path)
    return entries


_AT = "_case_hash"


def _attempts(spark, template, params, path, todo, names, scan_per_case):
    """Frames of cases with status, row_count, elapsed_sec and error_message."""
    ranges = [(-(1 << 63), (1 << 63) - 1)]
    while ranges:
        first, last = ranges.pop()
        cases = todo.where(F.col(_AT).between(first, last))
        if cases.isEmpty():
            continue
        started, planned = time.monotonic(), False
        try:
            if names:
                rows = extract_cases(
                    spark, template, params, cases=cases.select(*names), scan_per_case=scan_per_case
                )
                planned = True
                counted = _write_cases(rows, path, cases, names)
            else:
                rows, progress = observe_rows(extract(spark, template, params))
                planned = True
                write_parquet(rows, path, mode="overwrite")
                counted = cases.withColumn("row_count", F.lit(progress.get["rows"]).cast("bigint"))
        except Exception as error:
            if planned and first < last and cases.limit(2).count() > 1:
                middle = (first + last) // 2
                ranges += [(middle + 1, last), (first, middle)]
                continue
            elapsed = time.monotonic() - started
            yield _with_outcome(cases.withColumn("row_count", F.lit(0).cast("bigint")), elapsed, str(error))
        else:
            yield _with_outcome(counted, time.monotonic() - started, None)


def _write_cases(rows: DataFrame, path: str, cases: DataFrame, names: list[str]) -> DataFrame:
    """Write the slices of `cases`; the cases with their row counts."""
    spark = rows.sparkSession
    before = materialize(case_files(spark, path, names), "before")
    replace_slices(rows, path, names)
    if not before.isEmpty():
        drop_stale_slices(spark, path, before, cases, names)
    keys = T.StructType([rows.schema[n] for n in names])
    written = read_or_empty(spark, path, keys)
    # the partitions of these cases only, where their values are few enough to be named
    for key in names:
        values = [r[0] for r in cases.select(key).distinct().limit(NAMED_VALUES + 1).collect()]
        if len(values) <= NAMED_VALUES:
            written = written.where(F.col(key).isin(values))
    return materialize(rows_by_case(cases, written, names), "counted")


def _with_outcome(cases: DataFrame, elapsed: float, error: str | None) -> DataFrame:
    totals = cases.agg(F.sum("row_count"), F.count(F.lit(1))).first()
    share = (F.col("row_count") + 1) / F.lit(float(totals[0] + totals[1]))
    return cases.select(
        *LG.ATTEMPT_KEY,
        F.lit(LG.OK if error is None else LG.FAIL).alias("status"),
        "row_count",
        (share * elapsed).alias("elapsed_sec"),
        F.lit(error or "").alias("error_message"),
    )
