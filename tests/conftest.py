from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from estrato.config import LakeConfig  # noqa: E402
from estrato.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path):
    return LakeConfig(root=str(tmp_path / "lake"), environment="prod")
