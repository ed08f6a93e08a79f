from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caselake.session import scratch_database  # noqa: E402
from checks.compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        **{
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        }
    )
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    return scratch_database(spark)


@pytest.fixture
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
