import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from sheaf.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frames with a given schema and number of partitions."""

    def make(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture
def lines(frame):
    """One-column frames of text lines."""

    def make(texts, partitions=3):
        return frame([(text,) for text in texts], "value string", partitions)

    return make
