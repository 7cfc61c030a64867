from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sparktally.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.driver.host": "localhost",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_file(tmp_path):
    """Writes text into a fresh folder and returns the folder."""

    def write(text: str, name: str = "part.csv", folder: str = "input") -> str:
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        (target / name).write_text(text, encoding="utf-8")
        return str(target)

    return write


def values(rows, *columns):
    """The rows as tuples, in the order of the DataFrame."""
    picked = rows.select(*columns) if columns else rows
    return [tuple(row) for row in picked.collect()]
