from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strataflow.session import session

    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def lay(spark):
    from strataflow.sources.testtables import Layers

    return Layers(spark, TESTDATA)


@pytest.fixture
def folder(spark):
    """A new path below the shared folder."""
    from strataflow.session import fresh_path

    return fresh_path(spark, "test")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
