from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from brute import AWKWARD, AWKWARD_SCHEMA, SF  # noqa: E402



@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, AWKWARD_SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
