"""Fixtures of the text operators' tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus import DOCS, corpus, framed  # noqa: E402


@pytest.fixture(scope="session")
def small_docs() -> list[tuple[int, str | None]]:
    return corpus()


@pytest.fixture(scope="session")
def docs_frame(spark, small_docs):
    return framed(spark, small_docs).repartition(5).cache()


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
