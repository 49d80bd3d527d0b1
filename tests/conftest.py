import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.operators.align import align_to_schema  # noqa: E402
from ledgerlake.schemas import RAW  # noqa: E402
from ledgerlake.session import local_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


@pytest.fixture
def raw(spark):
    """RAW frame from dicts; missing columns are NULL."""
    def build(entity, rows):
        declared = RAW[entity]
        names = sorted({k for r in rows for k in r})
        schema = type(declared)([declared[n] for n in names])
        return align_to_schema(
            spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), declared)
    return build


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def epoch(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
