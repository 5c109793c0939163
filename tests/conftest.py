from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(TESTS.parent))
# Workers import the test modules that hold the stand-in extractors and judges.
os.environ["PYTHONPATH"] = os.pathsep.join([str(TESTS.parent), str(TESTS), os.environ.get("PYTHONPATH", "")])

from jobsignals.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="4g",
        spark_sql_warehouse_dir=tempfile.mkdtemp(prefix="warehouse-"),
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="shared-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_text(df) -> str:
    """The physical plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
