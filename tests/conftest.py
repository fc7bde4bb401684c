import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from studymart.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "studymart-tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(root / "shared"),
        spark__sql__warehouse__dir=str(root / "warehouse"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as a frame with the columns of a schema or a DDL string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)
