from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def shipped(spark):
    from hearthline.session import ship_package

    ship_package(spark)
