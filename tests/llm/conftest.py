from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def data_dir():
    return "/root/testdata/sf0.001"
