from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from llm_cases import CLASHING, COLUMNS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    return odd.withColumns({x: F.lit("x") for x in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
