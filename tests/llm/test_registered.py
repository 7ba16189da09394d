"""The registered queries: against SQL where there is some, else by their contract."""

from __future__ import annotations

import pytest
from compare import compare, duck
from conftest import SF_DIR
from parampipe.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_one_row_per_row(spark, name):
    table = {"op8_html": "pages", "op13_whiten": "embeddings"}.get(name, "documents")
    times = 8 if name == "op13_whiten" else 1
    expected = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count() * times
    assert queries.QUERIES[name](spark, SF_DIR).count() == expected


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns, name
        docs = corpus_pipeline.materialize(left, name)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == docs.count() == corpus_pipeline.run(spark, SF_DIR).count() > 0
