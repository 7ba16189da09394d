"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parampipe.plans import audit_queries, extract_queries, ledger_queries, load_queries
from parampipe.plans import step_queries

_MODULES = (extract_queries, load_queries, ledger_queries, audit_queries, step_queries)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step_queries.monthly_report(spark, sf_dir, "199501:199506")
