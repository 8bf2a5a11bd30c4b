"""Physical-plan properties the design relies on."""

import pytest

import __spark_entry__ as E
from lookout.plans import queries as Q

SF = "/root/testdata/sf0.001"
PYTHON_QUERIES = {"extract_places", "extract_records"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(E.queries()) - PYTHON_QUERIES))
def test_no_python_in_native_queries(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_batch_top_k_limits_before_shuffle(spark):
    # the search itself; the registered query writes its result before it fetches the places' columns
    from lookout.sources import tables
    plan = _plan(Q._model(spark, SF).ranked(tables.query_batch(spark, SF), Q.RANKED_K, maxima=False))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_single_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(Q.q_advanced_search(spark, SF))


def test_filters_reach_scans(spark):
    # the region filter of the search request is pushed into the place table scan
    plan = _plan(Q.q_advanced_search(spark, SF))
    assert "In(region, [AMERICA,ASIA,EUROPE])" in plan
    # building the place table reads every line item, but only the columns it needs
    from lookout.sources import tables
    li = _plan(tables.catalog(spark, SF))
    assert "GreaterThanOrEqual(l_quantity" not in li
    assert "l_returnflag" in li and "l_extendedprice" not in li and "l_comment" not in li


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(Q.q_page_bucket(spark, SF))
    assert "ReadSchema: struct<page_id:bigint>" in plan


def test_term_counts_do_not_shuffle(spark):
    from lookout.operators.corpus import term_counts
    from lookout.sources import tables
    assert "Exchange" not in _plan(term_counts(tables.table(spark, SF, "documents")))
