from __future__ import annotations

import os

import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": "America/New_York",  # results must not depend on it
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
