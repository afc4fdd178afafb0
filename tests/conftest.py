import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import tests  # noqa: E402
from foliospark.session import build_session  # noqa: E402

# Functions of the test modules travel to the workers by value, like the library's own.
cloudpickle.register_pickle_by_value(tests)


def make_session():
    spark = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="foliospark-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
