import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import samples  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return samples.documents(spark)


@pytest.fixture(scope="session")
def no_docs(spark):
    return samples.no_documents(spark)
