"""A whole folder of templates: lint, order, extract, load, union, SQL steps, one ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.functions import templates as TP
from parampipe.functions.naming import PART_SEPARATOR, table_of_template
from parampipe.operators import audit as A
from parampipe.operators import ledger as LG
from parampipe.operators import load as L
from parampipe.operators.runs import run_extract
from parampipe.operators.sinks import case_files
from parampipe.operators.views import union_parts
from parampipe.plans.steps import run_steps
from parampipe.session import delete_path
from parampipe.sources.files import file_inventory, template_corpus

PART = "file_suffix"
# A folder with more templates is refused.
MOST_TEMPLATES = 10_000


@dataclass(frozen=True)
class FolderRun:
    """What a run leaves: the template files, the lint findings, the ledger, the last step's rows."""

    files: DataFrame
    lint: DataFrame
    ledger: DataFrame
    result: DataFrame | None


def ordered_templates(spark: SparkSession, sql_dir: str) -> DataFrame:
    """Templates of a folder in run order, with the table each loads."""
    corpus = template_corpus(spark, sql_dir)
    named = corpus.withColumn("name", F.concat("stem", F.lit(".sql"))).withColumn(
        "table_name", table_of_template(F.col("text"), F.col("stem"))
    )
    return A.file_order(named, "name", "position")


def run_folder(
    spark: SparkSession,
    sql_dir: str,
    params: dict[str, str],
    root: str,
    batch_ts: str,
    steps: dict[str, str] | None = None,
    host: str = "local",
    scan_per_case: bool = False,
) -> FolderRun:
    """Run every template below `sql_dir` for its cases, then the steps over the tables.

    Nothing starts when a template lacks a parameter; other lint findings are reported only.
    Each template is extracted to its own folder below `root`, and its parts are loaded into
    its table: each once, and again when its files were written anew, so a changed template
    replaces its own slices and those of no other. Templates may name one table; tables
    named ``base__part`` are one table ``base`` to the steps. All attempts and steps are
    in one ledger below `root`. `scan_per_case` lets templates run that have no key.
    """
    ledger_path = f"{root}/ledger"
    target = L.Target(spark, f"{root}/warehouse", host, "folder")
    ordered = ordered_templates(spark, sql_dir).orderBy("position").limit(MOST_TEMPLATES + 1).collect()
    if len(ordered) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    names = {row["sql_path"]: TP.marker_names(TP.to_markers(row["text"])) for row in ordered}
    missing = {path: sorted(set(own) - set(params)) for path, own in names.items() if set(own) - set(params)}
    if missing:
        raise ValueError(f"missing params {missing}")
    tables: dict[str, list[DataFrame]] = {}
    for row in ordered:
        path = f"{root}/extract/{row['sql_path']}"
        run_extract(
            spark, row["sql_path"], row["text"], params, path, ledger_path, batch_ts, host, scan_per_case=scan_per_case
        )
        loaded = _load(target, row["table_name"], row["sql_path"], path, names[row["sql_path"]])
        if loaded is not None:
            base = row["table_name"].split(PART_SEPARATOR)[0]
            tables.setdefault(base, []).append(loaded)
    for base, parts in tables.items():
        union_parts(parts).createOrReplaceTempView("`" + base.replace("`", "``") + "`")
    result = None
    if steps:
        result, entries = run_steps(spark, steps, batch_ts)
        LG.append_rows(entries, ledger_path)
    for base in tables:
        spark.catalog.dropTempView(base)
    lint = A.lint_report(template_corpus(spark, sql_dir), list(params))
    return FolderRun(file_inventory(spark, sql_dir, True, "*.sql"), lint, LG.read_ledger(spark, ledger_path), result)


def _load(target: L.Target, table: str, template: str, path: str, names: list[str]) -> DataFrame | None:
    """Load the parts of an extract; the template's rows of the table, None if nothing was extracted.

    A part is named by its template and case, so templates of one table keep apart.
    """
    own = case_files(target.spark, path, names)
    parts = own.select(F.concat_ws("_", F.lit(template), *names).alias(PART)).distinct()
    _drop_gone(target, table, template, parts)
    if own.isEmpty():
        return None
    source = target.spark.read.parquet(path)
    # folder names are texts, whatever the reader takes them for
    source = source.withColumns({n: F.col(n).cast("string") for n in names})
    source = source.withColumn(PART, F.concat_ws("_", F.lit(template), *names))
    L.load_parts(target, table, source, PART, identity=L.BY_FILES)
    return target.table(table, source.schema).where(_of_template(template))


def _of_template(template: str) -> Column:
    return (F.col(PART) == template) | F.col(PART).startswith(f"{template}_")


def _drop_gone(target: L.Target, table: str, template: str, parts: DataFrame) -> None:
    """Remove the loaded slices of a template's cases that have no rows any more."""
    loaded = case_files(target.spark, target.table_path(table), [PART]).where(_of_template(template))
    gone = loaded.join(parts, PART, "left_anti")
    folders = gone.select(F.regexp_replace("_file", r"/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        delete_path(target.spark, row["folder"])
