from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from varve.session import ship  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def sf_texts(spark):
    ship(spark)
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def docs(spark):
    from edges import edge_docs

    ship(spark)
    return edge_docs(spark)


@pytest.fixture(scope="session")
def no_docs(spark):
    from edges import empty_docs

    ship(spark)
    return empty_docs(spark)
