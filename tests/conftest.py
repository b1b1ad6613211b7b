import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from salesmart.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf(spark):
    return f"{DATA}/sf0.001"
