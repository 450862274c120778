import pytest

from compare import connect, differences
from __spark_entry__ import entry, oracle_sql, queries
from inkwell.plans.oracle import ORACLES
from inkwell.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(queries()[name](spark, SMALL), con, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 20


def test_no_cross_joins_or_python_outside_the_two_helpers(spark):
    """Plans of all lazily built queries; YAML typing and user functions are the only Python."""
    for name in ("newsletter_candidates", "mart_posts", "feed_entries", "page_cards", "ingest_dedup", "summary_store",
                 "post_notes", "source_notes", "quality_report", "dlq_after_reprocess", "daily_run"):
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert "Python" not in plan and "InPandas" not in plan, name
