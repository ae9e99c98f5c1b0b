from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardline.plans import load  # noqa: E402
from wardline.session import local_session  # noqa: E402

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clinic import AS_OF, write_extracts  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=2)


@pytest.fixture
def as_of() -> date:
    return AS_OF


@pytest.fixture(scope="session")
def root(tmp_path_factory) -> str:
    """The folder under which the small clinic is published."""
    return str(tmp_path_factory.mktemp("root"))


@pytest.fixture(scope="session")
def loaded(spark, tmp_path_factory, root):
    """The small clinic, loaded once for all tests that do not change it."""
    source = write_extracts(tmp_path_factory.mktemp("extracts"))
    return load.load_csv(spark, source, root, AS_OF)


@pytest.fixture(scope="session")
def core(loaded):
    return loaded.core
