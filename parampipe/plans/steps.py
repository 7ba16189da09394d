"""Ordered SQL steps over loaded tables, recorded in the run ledger.

A step is worked out while it is timed: the rows of its views and of its last query
are written to the shared scratch area. The ledger names that place, so that a later
session that skips the step finds its views again.
"""

from __future__ import annotations

import hashlib
import json
import re
import time

from pyspark.sql import DataFrame, SparkSession

from parampipe.functions.templates import pieces
from parampipe.operators.ledger import FAIL, LEDGER_SCHEMA, OK
from parampipe.session import materialize

# Host and parameter text of a step in the ledger.
STEP_HOST = "spark"
STEP_PARAMS = "-"

_VIEW = re.compile(
    r"\s*CREATE\s+(?:OR\s+REPLACE\s+)?(?:GLOBAL\s+)?TEMP(?:ORARY)?\s+VIEW\s+(?:IF\s+NOT\s+EXISTS\s+)?"
    r"(`[^`]+`|\w+)\s+AS\b(.*)",
    re.IGNORECASE | re.DOTALL,
)


def step_hash(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def select_steps(steps: dict[str, str], name_filter: str | None = None) -> list[tuple[str, str]]:
    """Steps in name order, kept when the name contains one of the filter's parts."""
    chosen = sorted(steps.items())
    if name_filter:
        parts = [p.strip().lower() for p in name_filter.split(",")]
        chosen = [(n, t) for n, t in chosen if any(p in n.lower() for p in parts)]
    return chosen


def statements(text: str) -> list[str]:
    """The statements of a step; ``;`` in literals and comments does not end one. A
    BEGIN ... END script is one statement."""
    if text.lstrip().upper().startswith("BEGIN"):
        return [text.strip().rstrip(";")]
    found = [""]
    for kind, piece in pieces(text):
        if kind == "code":
            first, *rest = piece.split(";")
            found[-1] += first
            found += rest
        elif kind != "comment":
            found[-1] += piece
        else:
            found[-1] += " "
    return [s.strip() for s in found if s.strip()]


def run_step(spark: SparkSession, text: str) -> tuple[DataFrame | None, dict[str, str]]:
    """Run one step to its end: the rows of its last query, and the place of every view."""
    result, views = None, {}
    for statement in statements(text):
        view = _VIEW.fullmatch(statement)
        rows = spark.sql(view.group(2) if view else statement)
        if not rows.columns:
            continue
        rows = materialize(rows, "step")
        if view:
            name = view.group(1).strip("`")
            rows.createOrReplaceTempView(name)
            views[name] = rows.scratch_path
        else:
            result = rows
    return result, views


def restore_views(spark: SparkSession, output: str) -> None:
    """Make the views of an earlier run of a step from what its ledger row names."""
    for name, path in json.loads(output or "{}").items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def run_steps(
    spark: SparkSession,
    steps: dict[str, str],
    batch_ts: str,
    done: dict[tuple[str, str], str] | None = None,
    name_filter: str | None = None,
    fail_fast: bool = False,
) -> tuple[DataFrame | None, DataFrame]:
    """Run the steps in order; returns the last step's result and the ledger rows.

    Steps whose (name, text hash) is in `done` are skipped and their views restored.
    A failing step, also one that fails only when its rows are worked out, is
    recorded and the next one runs, unless `fail_fast`.
    """
    ledger, result = [], None
    for name, text in select_steps(steps, name_filter):
        digest = step_hash(text)
        if done and (name, digest) in done:
            restore_views(spark, done[name, digest])
            continue
        started = time.monotonic()
        status, message, views = OK, "", {}
        try:
            found, views = run_step(spark, text)
            result = found if found is not None else result
        except Exception as error:
            if fail_fast:
                raise
            status, message = FAIL, str(error)
        elapsed = round(time.monotonic() - started, 2)
        output = json.dumps(views, sort_keys=True) if views else ""
        ledger.append(
            (batch_ts, STEP_HOST, name, STEP_PARAMS, digest, status, None, elapsed, output, message)
        )
    return result, spark.createDataFrame(ledger, LEDGER_SCHEMA)


def done_steps(ledger: DataFrame, success: DataFrame) -> dict[tuple[str, str], str]:
    """(name, text hash) of succeeded steps with the place of their views; as many as
    there are step files."""
    keys = ["host", "sql_file", "params", "sql_hash"]
    rows = ledger.where(ledger.status == OK).join(success, keys, "left_semi").orderBy("batch_ts")
    return {
        (r["sql_file"], r["sql_hash"]): r["output_file"]
        for r in rows.select("sql_file", "sql_hash", "output_file").collect()
    }
