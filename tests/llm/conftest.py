from __future__ import annotations

import pytest

from llm.samples import SCHEMA, make_rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents under other names, with columns named like those of the operators."""
    extra = {c: "1 as " + c for c in ("set", "hash", "row", "n", "list", "part", "batch", "kept", "term", "component")}
    return docs.selectExpr("doc_id as id", "text as body", *extra.values())
