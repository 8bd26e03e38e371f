import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from strata.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return session


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def at(day: int, hour: int = 0, month: int = 6) -> datetime:
    return datetime(2026, month, day, hour)


def sets(frame, *columns):
    return {tuple(r[c] for c in columns) for r in frame.collect()}


def plan_text(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
