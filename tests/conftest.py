import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from fareloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "fareloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
