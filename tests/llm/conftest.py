import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def docs(spark):
    """``doc_id, text`` frames with some more columns, dealt over several partitions."""

    def make(rows, extra="", partitions=3):
        schema = "doc_id bigint, text string" + extra
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return lambda name: str(public_tokenizers.path(name))
