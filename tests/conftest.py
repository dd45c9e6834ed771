import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def records(spark):
    """Build records from JSON texts, numbered from 1."""
    from recordloom.sources.records import read_records

    def make(*texts):
        df = spark.createDataFrame(list(enumerate(texts, 1)), "id bigint, raw string")
        return read_records(df, "raw", "id").records

    return make
