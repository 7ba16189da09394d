"""Run ledger: what ran, what succeeded, what is left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.sources.files import read_or_empty

OK, FAIL = "OK", "FAIL"

# Column names of the ledger, in order, and the key of an attempt.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_ts", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("sql_file", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("sql_hash", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("elapsed_sec", T.DoubleType()),
        T.StructField("output_file", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
ATTEMPT_KEY = ["host", "sql_file", "params", "sql_hash"]

# Rows of the slow report, timestamp text.
SLOW_ROWS = 10
BATCH_FORMAT = "yyyyMMdd_HHmmss"


def batch_text(ts: Column) -> Column:
    return F.date_format(ts, BATCH_FORMAT)


def format_rows(df: DataFrame) -> DataFrame:
    """Ledger columns in order: seconds rounded half-even, the whole error text."""
    return df.select(
        "batch_ts",
        "host",
        "sql_file",
        "params",
        "sql_hash",
        "status",
        F.col("rows").cast("bigint").alias("rows"),
        F.bround("elapsed_sec", 2).alias("elapsed_sec"),
        F.coalesce("output_file", F.lit("")).alias("output_file"),
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    )


def append_rows(df: DataFrame, path: str) -> None:
    """Append ledger rows, one partition per batch. A row that is written twice
    changes no answer taken from the ledger."""
    (
        format_rows(df)
        .hint("rebalance", F.col("batch_ts"))
        .write.mode("append")
        .partitionBy("batch_ts")
        .parquet(path)
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, LEDGER_SCHEMA)


def latest_batch(ledger: DataFrame) -> DataFrame:
    """Rows of the newest batch; the batch is found first and prunes the scan."""
    newest = ledger.select("batch_ts").agg(F.max("batch_ts"))
    return ledger.where(F.col("batch_ts") == newest.scalar())


def success_keys(
    ledger: DataFrame, keys: list[str] | None = None, scope: str = "all", order: str = "batch_ts"
) -> DataFrame:
    """Keys whose last attempt succeeded.

    ``all`` takes each key's last attempt over all batches; ``last_run`` looks at
    the newest batch only. The times of the last attempt and of the last
    success are running maxima, combined before the shuffle: no key's rows are
    sorted or gathered. `order` is a time, a number or a batch text of digits. Attempts at the same time count as a success if one succeeded.
    """
    names = keys or ATTEMPT_KEY
    if scope == "last_run":
        return latest_batch(ledger).where(F.col("status") == OK).select(*names).distinct()
    return _last_attempts(ledger, names, order).where("_last_ok = _last").select(*names)


def _last_attempts(ledger: DataFrame, names: list[str], order: str) -> DataFrame:
    at = F.col(order)
    if isinstance(ledger.schema[order].dataType, T.StringType):
        # a batch text is a number of up to 18 digits: numbers stay in a hash aggregate
        at = F.rpad(F.regexp_replace(at, r"\D", ""), 18, "0").try_cast("bigint")
    return ledger.groupBy(*names).agg(
        F.max(at).alias("_last"),
        F.max(F.when(F.col("status") == OK, at)).alias("_last_ok"),
    )


def pending(cases: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cases that are not done; keys compare NULL-safe.

    Bare keys are united with the done ones and grouped: one shuffle of
    combined keys. (An anti-join would be pushed below a DISTINCT of the cases
    and shuffle the raw rows.) Cases with further columns are anti-joined.
    """
    names = keys or ATTEMPT_KEY
    if set(cases.columns) == set(names):
        marked = cases.select(*names, F.lit(False).alias("_done")).unionAll(
            done.select(*names, F.lit(True))
        )
        states = marked.groupBy(*names).agg(F.bool_or("_done").alias("_done"))
        return states.where(~F.col("_done")).select(*cases.columns)
    same = [cases[k].eqNullSafe(done[k]) for k in names]
    return cases.join(done, same, "left_anti")


def retryable(
    ledger: DataFrame, keys: list[str] | None = None, order: str = "batch_ts", rounds: int | None = 3
) -> DataFrame:
    """Keys that failed since their last success, fewer than `rounds` times (None: any).

    Failures before a success do not count. Attempts at the time of a success
    belong to it. Failures are counted by time first, so what meets the last
    successes in the join is one row per key and time.
    """
    names = keys or ATTEMPT_KEY
    succeeded = ledger.where(F.col("status") == OK).groupBy(*names).agg(F.max(order).alias("_last_ok"))
    failed = ledger.where(F.col("status") == FAIL).groupBy(*names, F.col(order).alias("_at")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in names]
    since = failed.alias("f").join(succeeded.alias("s"), same, "left").where(
        F.col("_last_ok").isNull() | (F.col("_at") > F.col("_last_ok"))
    )
    counted = since.groupBy(*[F.col(f"f.{k}").alias(k) for k in names]).agg(F.sum("_n").alias("failures"))
    return counted if rounds is None else counted.where(F.col("failures") < rounds)


def failed_templates(ledger: DataFrame) -> DataFrame:
    """Distinct (host, sql_file) that failed."""
    return ledger.where(F.col("status") == FAIL).select("host", "sql_file").distinct()


def retry_targets(templates: DataFrame, failed: DataFrame, key: str = "sql_file") -> DataFrame:
    """Templates whose name is among the failed ones."""
    return templates.join(failed.select(key).distinct(), key, "left_semi")


def slowest(ledger: DataFrame, tie_break: list[Column], n: int = SLOW_ROWS) -> DataFrame:
    """The `n` attempts with the longest run time."""
    return ledger.orderBy(F.col("elapsed_sec").desc(), *tie_break).limit(n)


def schema_of_host(hosts: DataFrame, mapping: DataFrame, host: str, schema: str) -> DataFrame:
    """Configured schema of every host, the host itself where none is configured.

    A host that is configured more than once has the least of its schemas.
    """
    known = mapping.groupBy(F.col(host).alias("_host")).agg(F.min(schema).alias("_schema"))
    joined = hosts.join(known, hosts[host] == F.col("_host"), "left")
    return joined.withColumn("target_schema", F.coalesce("_schema", F.col(host))).drop(
        "_host", "_schema"
    )
