from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tests", "local[4]", 4, settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Write documents of one source as a file of JSON lines in the landing folder."""
    landing = tmp_path / "landing"

    def write(source: str, documents: list[dict], name: str = "first") -> str:
        folder = landing / source
        folder.mkdir(parents=True, exist_ok=True)
        text = "\n".join(json.dumps(document) for document in documents)
        (folder / f"{name}.json").write_text(text + "\n", encoding="utf-8")
        return str(landing)

    return write
