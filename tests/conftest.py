import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orefold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "4"), "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Evaluate expressions over literal rows: rows([(..), ..], "ddl", column, ...) -> list of values or tuples."""

    def evaluate(data, ddl, *columns):
        found = spark.createDataFrame(data, ddl).select(*columns).collect()
        return [row[0] if len(columns) == 1 else tuple(row) for row in found]

    return evaluate
