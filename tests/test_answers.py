"""Every registered query against its expected answer, on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_answer(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLE.get(name)) is None


def test_every_answer_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
