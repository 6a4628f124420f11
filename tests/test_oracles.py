"""Every registered query against its SQL on the smallest tables.

Queries that take many Spark jobs run too if BOUNDARYSPARK_ALL is set; `oracle_check.py` runs
everything at any scale.
"""

import os

import pytest

SMALL = "/root/testdata/sf0.001"
MANY_JOBS = {
    "composite_layers", "simplify", "simplify_fraction", "repair", "repair_bow_ties", "overlay_union", "overlay_difference",
    "matched_units", "unmatched_units", "best_matches", "rank_relations", "significant_relations", "total_agreement", "fill_gaps",
    "clip", "check_summary", "check_labels", "build_issue_digest", "write_api_index"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="tables are not here")


def names():
    from boundaryspark.plans import all_queries
    chosen = [n for n in all_queries.QUERIES if os.environ.get("BOUNDARYSPARK_ALL") or n not in MANY_JOBS]
    return chosen


@pytest.fixture(scope="module")
def con():
    from oracle_check import connect
    return connect(SMALL)


@pytest.mark.parametrize("name", names())
def test_same_as_sql(spark, con, name):
    import __spark_entry__ as driver
    from oracle_check import compare
    result = compare(spark, con, name, driver.queries()[name], driver.oracle_sql().get(name), SMALL)
    assert result.startswith(("same", "rows")), result


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
