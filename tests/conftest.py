"""One local session for all tests, with its own warehouse and workspace."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowtables.session import build_session  # noqa: E402


def make_session():
    root = tempfile.mkdtemp(prefix="flowtables-test-")
    spark = build_session(
        "flowtables-tests", "local[8]",
        spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__warehouse__dir=f"{root}/warehouse", spark__checkpoint__dir=f"{root}/workspace",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture()
def db(spark, tmp_path):
    """A database that is dropped after the test."""
    import uuid

    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    yield name
    spark.catalog.setCurrentDatabase(before)
    spark.sql(f"DROP DATABASE {name} CASCADE")
