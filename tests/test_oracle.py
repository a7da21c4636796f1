"""A sample of the named queries against the SQL engine, on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from pulsemark.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
NAMES = ["entry_label_rates", "latest_poll", "clean_table", "engineered", "health_warnings", "spot_check",
         "iqr_outliers", "kde", "label_rates_bootstrap", "range_join", "boosting_first_splits", "forest_first_splits", "stratified_folds",
         "correlation", "channel_draw", "stream_labels", "stream_sorted_out", "raw_items_parsed"]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees(spark, con, name):
    ok, _, note = compare(spark, con, SMALL, name, QUERIES[name], ORACLE[name])
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert len(rows) == 15 and all(0 <= r.rate <= 1 for r in rows)
