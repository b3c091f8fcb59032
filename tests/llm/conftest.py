"""Small tables with the awkward cases every operator has to bear."""

from __future__ import annotations

import pytest
from text_helpers import AWKWARD, SF, awkward_rows


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), AWKWARD)


@pytest.fixture(scope="session")
def awkward_pairs():
    return [(r[0], r[1]) for r in awkward_rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], AWKWARD)
