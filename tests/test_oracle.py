"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import __spark_entry__ as entry
import pytest
from compare import spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
# Queries of the training-text operators, where they are there, have tests of their own.
OTHERS = set(entry.llm.queries()) if entry.llm else set()
QUERIES = {name: query for name, query in entry.queries().items() if name not in OTHERS}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name not in OTHERS}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, name):
    names, _, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    sql_names, _, expected = sql_rows(SF_DIR, ORACLES[name])
    assert sorted(names) == sorted(sql_names)
    assert rows == expected


def test_entry(spark):
    # One of the ten doctors has no visit.
    assert entry.entry(spark).count() == 9
