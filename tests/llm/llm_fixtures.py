"""Fixtures that the tests of this folder import; a second conftest would hide the first from them."""

from __future__ import annotations

import pytest
from oracle import connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)
