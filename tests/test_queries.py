"""Every registered query against its SQL on DuckDB."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SMALL

def own(found):
    """Without the corpus queries, which have tests of their own."""
    return {name: value for name, value in found.items() if not re.match(r"op\d+_|pipeline$", name)}


QUERIES, SQL = own(entry.queries()), own(entry.oracle_sql())
ROWS_ONLY = {"layout_file_stats", "layout_skippable_files"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql_but_the_named_ones():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    verdict, rows = difference(QUERIES[name](spark, SMALL), duck, SQL[name])
    assert verdict is None
    assert rows > 0 or name in ("lab_selective_window", "lab_single_day")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
