import datetime as dt
import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmark.clock import RunClock  # noqa: E402
from shelfmark.schemas import ENTITIES  # noqa: E402
from shelfmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clock():
    return RunClock.on("2025-01-01")


LOADED = dt.datetime(2024, 12, 31, 2)


@pytest.fixture(scope="session")
def raw(spark):
    """raw(entity, rows): literal raw rows; missing columns are NULL, ids count up from 1."""

    def build(entity, rows):
        e = ENTITIES[entity]
        data = []
        for i, row in enumerate(rows, 1):
            row = {"Raw_ID": i, "Batch_ID": "b1", "Source_File": e.file, "Load_Timestamp": LOADED, **row}
            unknown = set(row) - {f.name for f in e.raw_schema}
            assert not unknown, unknown
            data.append(tuple(row.get(f.name) for f in e.raw_schema))
        return spark.createDataFrame(data, e.raw_schema)

    return build


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def column(df):
    return [r[0] for r in df.collect()]


__all__ = ["T"]
