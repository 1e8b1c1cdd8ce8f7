from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session

    session = build_session(
        "tillroll-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    return SF_SMALL


@pytest.fixture(scope="session")
def raw_small(spark, sf_small):
    from tillroll.sources.fixtures import raw_retail_lines

    return raw_retail_lines(spark, sf_small)


@pytest.fixture(scope="session")
def clean_small(spark, raw_small, tmp_path_factory):
    """The cleaned sf0.001 table, written once and re-read."""
    from tillroll.operators.clean import clean

    path = str(tmp_path_factory.mktemp("clean") / "cleaned")
    clean(raw_small).write.parquet(path)
    return spark.read.parquet(path)


def raw_frame(spark, rows):
    """Raw invoice lines from tuples in REQUIRED_COLUMNS order."""
    from tillroll.schema import RAW_SCHEMA

    return spark.createDataFrame(rows, RAW_SCHEMA)
