from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Fresh paths by name."""
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex[:8]}")


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
