"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from parampipe.plans import registry
from compare import compare, duck
from conftest import SF_DIR

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert sorted(r.cls_yymm for r in rows) == [f"19950{i}" for i in range(1, 7)]
