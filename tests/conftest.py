from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from logweir.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
