from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hearthline.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests", 8, **{"spark.checkpoint.dir": str(base / "shared"), "spark.sql.warehouse.dir": str(base / "warehouse")}
    )
    yield session
    session.stop()
