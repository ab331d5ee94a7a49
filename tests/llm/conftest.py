from __future__ import annotations

import pytest
from tests.llm.support import AWKWARD, documents


@pytest.fixture(scope="session")
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture(scope="session")
def no_documents(spark):
    return documents(spark, [])
