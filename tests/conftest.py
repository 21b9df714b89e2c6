import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewlens.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def evaluate(spark):
    """Evaluate a column expression over single values."""

    def run(values, make, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        found = rows.select("i", make("v").alias("out")).collect()
        return [row["out"] for row in sorted(found, key=lambda row: row["i"])]

    return run
