"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_agrees(spark, con, name):
    assert check.compare(spark, con, SMALL, name) == ""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["subreddit", "year_month", "n", "avg_len"]
    assert df.count() > 0
