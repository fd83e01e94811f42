from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tapeloom.session import local_session

    session = local_session("tests", 8, spark__sql__shuffle__partitions="4", spark__driver__memory="6g")
    yield session
    session.stop()
