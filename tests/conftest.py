from __future__ import annotations

import os
import sys
from datetime import UTC, datetime

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tradelake.schemas import Layout  # noqa: E402
from tradelake.session import configure  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tradelake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def folder():
    return DATA


def at(day: int, hour: int = 0, minute: int = 0, second: int = 0) -> datetime:
    """A moment in April 2026."""
    return datetime(2026, 4, day, hour, minute, second, tzinfo=UTC)
