"""One local session for all tests."""

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]
# Python workers import classifiers from the test modules.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])

from jobsluice.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="jobsluice-test-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
