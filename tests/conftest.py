from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from perennia.session import get_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "perennia-tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
