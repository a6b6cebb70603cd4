import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from wattlake import schemas  # noqa: E402
from wattlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a table of the declared layout from dicts; absent columns are NULL."""

    def build(name, records):
        schema = schemas.SAMPLES if name == "samples" else schemas.TABLES[name]
        loose = schemas.without_constraints(schema)
        return spark.createDataFrame(
            [tuple(r.get(f.name) for f in loose.fields) for r in records], loose
        )

    return build


@pytest.fixture
def now():
    return dt.datetime(2024, 1, 31, 8, 0)
