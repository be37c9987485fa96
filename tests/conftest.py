from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import database, session  # noqa: E402
from checks.inputs import Inputs  # noqa: E402
from logferry.schemas import LOG  # noqa: E402
from logferry.sources.cluster import Cluster  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Compiling generated code costs more than running these few rows.
    spark = session(4, **{"spark.sql.codegen.wholeStage": "false"})
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def db():
    return database(FOLDER)


@pytest.fixture(scope="session")
def inputs(spark):
    return Inputs(spark, FOLDER)


@pytest.fixture
def source(spark, tmp_path):
    return Cluster(spark, str(tmp_path / "source"), "source-cluster")


@pytest.fixture
def dest(spark, tmp_path):
    return Cluster(spark, str(tmp_path / "dest"), "dest-cluster")


@pytest.fixture
def make_log(spark):
    """LOG rows from (partition, offset, value) or full tuples."""

    def build(*rows):
        full = [r if len(r) == 6 else (r[0], r[1], None, b"k", r[2], []) for r in rows]
        return spark.createDataFrame(full, LOG)

    return build
