"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from matchlake.plans.queries import QUERIES
from compare import connect, differences

FOLDER = os.environ.get("MATCHLAKE_SF_DIR", "/root/testdata/sf0.001")
# These end in at most a handful of rows, or in none, when there is little data.
MAY_BE_EMPTY = {"split_dead_letters", "meta_view", "meta_view_stored", "item_combo_winrate", "item_combo_per_copy", "medallion_refresh", "incremental_gold"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql())


@pytest.mark.filterwarnings("ignore::UserWarning")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = differences(entry_module.queries()[name](spark, FOLDER), con, entry_module.oracle_sql()[name])
    if name in MAY_BE_EMPTY:
        found = [f for f in found if f != "the comparison is empty"]
    assert not found


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
