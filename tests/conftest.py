from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from keelson.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(root / "warehouse"), spark__checkpoint__dir=str(root / "shared"),
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS unit")
    return "unit"
