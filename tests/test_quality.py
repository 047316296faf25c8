"""Data-quality checks on rows that break them, and on clean ones."""
import datetime as dt

from conftest import SF_SMALL
from saleslens.operators import quality as q


def test_ids_that_the_history_holds(spark):
    batch = spark.createDataFrame([(1,), (2,), (2,), (None,)], "SalesOrderID long")
    history = spark.createDataFrame([(2,), (3,), (None,)], "SalesOrderID long")
    assert [r.SalesOrderID for r in q.keys_present(batch, history, "SalesOrderID").collect()] == [2, 2]
    assert q.keys_present(batch.limit(0), history, "SalesOrderID").count() == 0


def test_keys_without_a_parent(spark):
    lines = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "SalesOrderDetailID long, ProductID long")
    products = spark.createDataFrame([(10,), (None,)], "ID long")
    assert [r.SalesOrderDetailID for r in q.missing_in(lines, products, "ProductID", "ID").collect()] == [2]


def test_prices_missing_zero_or_below(spark):
    day = dt.date(2000, 1, 1)
    lines = spark.createDataFrame([(p,) for p in (1, 1, 2, 3, 4, 5)], "ProductID long")
    prices = spark.createDataFrame([(1, None, 5.0), (2, None, 0.0), (3, day, 9.0), (4, None, -1.0), (4, day, 2.0)],
                                   "ProductID long, EndDate date, ListPrice double")
    got = {(r.ProductID, r.ListPrice) for r in q.price_positive(lines, prices).collect()}
    assert got == {(2, 0.0), (3, None), (4, -1.0), (5, None)}


def test_online_orders_with_a_salesperson(spark):
    rows = [(1, True, None), (2, True, 5), (3, False, 5), (4, None, 5)]
    header = spark.createDataFrame(rows, "SalesOrderID long, OnlineOrderFlag boolean, SalesPersonID long")
    assert [r.SalesOrderID for r in q.online_with_salesperson(header).collect()] == [2]


def test_registered_checks_find_faults(spark):
    from conftest import SF_SMALL
    from saleslens import catalog
    for key in ("dq_no_overlap_history", "dq_products_allowed", "dq_price_positive", "dq_online_no_salesperson", "dq_foreign_keys"):
        assert not catalog.queries()[key](spark, SF_SMALL).isEmpty(), key


def test_orphan_keys_sums_rows_before_the_join(spark):
    child = spark.createDataFrame([(k % 5 if k % 7 else None,) for k in range(700)], "k long")
    parent = spark.createDataFrame([(0,), (1,), (1,), (None,)], "p long")
    found = q.orphan_keys(q.key_counts(child, "k"), parent, "k", "p")
    assert sorted(map(tuple, found.collect())) == [(k, 120) for k in (2, 3, 4)]
    plan = q.orphan_keys(q.key_counts(spark.range(10).withColumnRenamed("id", "k"), "k"), parent, "k", "p")._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Join") < plan.index("HashAggregate")          # the sum lies under the join


def test_foreign_keys_sum_the_lines_of_an_order_before_they_are_shuffled(spark):
    from saleslens.catalog import quality
    plan = quality.q_dq_foreign_keys(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # The scan of the lines' orders alone: above it, sums come before the exchange.
    i = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_orderkey" in x and "l_partkey" not in x)
    assert "HashAggregate" in next(x for x in lines[:i][::-1] if "Exchange" in x or "HashAggregate" in x)
