"""Every registered query against its SQL twin on the smallest data."""

import pytest
from compare import connect, differences
from conftest import FOLDER

from olapkit.registry import ORACLES, QUERIES

# Chosen constants select nothing in the smallest data.
MAY_BE_EMPTY = {"count_key", "metric_fetch", "pruned_scan"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name not in ORACLES:
        assert df.count() > 0
        return
    problems = differences(df, duck, ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "oracle is empty"]
    assert not problems
