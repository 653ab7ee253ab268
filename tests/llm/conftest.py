import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tests.llm.fixtures import awkward, empty  # noqa: E402


@pytest.fixture(scope="session")
def rows(spark):
    return awkward(spark)


@pytest.fixture(scope="session")
def none(spark):
    return empty(spark)
