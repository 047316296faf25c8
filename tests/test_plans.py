"""Physical-plan properties that matter at scale (read from explain output)."""
import contextlib
import io

import pytest

from conftest import SF_SMALL

LAZY_KEYS = ["fact_sales_margin", "agg_country_subcategory", "doc_revenue_margin", "history_profile",
             "dq_cost_coverage", "join_scd2_cost", "join_scd2_list_price", "range_join_offer_tier",
             "doc_cohort_retention", "agg_product_quantiles", "doc_hierarchy_rollup", "anti_unsold_products"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as E
    return E.queries()


@pytest.mark.parametrize("key", LAZY_KEYS)
def test_no_cartesian_product(spark, qs, key):
    p = plan(qs[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p


def test_fact_plan_prunes_pushes_and_avoids_nested_loops(spark, qs):
    p = plan(qs["fact_sales_margin"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in p
    # only the six line columns the fact needs are read
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,"
            "l_extendedprice:double,l_discount:double>") in p
    # the history cut-off reaches the orders scan
    assert "LessThan(o_orderdate,2001-07-02T00:00)" in p or "LessThanOrEqual(o_orderdate" in p


def test_monitoring_aggregates_before_joining_dimensions(spark, qs):
    from saleslens.catalog.pipelines import current_pairs, AS_OF
    from saleslens.sources.fixtures import SalesTables
    p = plan(current_pairs(SalesTables.of(spark, SF_SMALL), AS_OF))
    # partial aggregation of the fact by (ProductID, TerritoryID) happens below the dimension joins
    first_partial = p.find("partial_sum")
    assert first_partial != -1
    assert "Keys [2]: [ProductID" in p


def test_interval_join_uses_equi_key_with_residual_range(spark, qs):
    p = plan(qs["join_scd2_cost"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in p
    assert "Join condition: ((OrderDate" in p


def test_bucketed_lines_and_headers_join_without_shuffle(spark, work):
    import uuid
    from saleslens.plans import fact as fact_plan
    from saleslens.sources import files
    from saleslens.sources.fixtures import SalesTables
    t = SalesTables.of(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:8]
    d = files.write_bucketed(t.detail_all.select(*fact_plan.DETAIL_COLS), f"lines_{tag}", "SalesOrderID", 8,
                             work("bucketed-lines"))
    h = files.write_bucketed(t.header_hist, f"headers_{tag}", "SalesOrderID", 8, work("bucketed-headers"))
    j = fact_plan.lines_with_header(d, h)
    p = plan(j)
    assert "Exchange" not in p                       # neither side is shuffled
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert j.count() == t.detail_hist.count()
    f = fact_plan.fact_sales_margin(d, h, t.cost_history)
    assert f.count() == fact_plan.fact_sales_margin(t.detail_all, t.header_hist, t.cost_history).count()
