"""Invariants and idempotence from the test strategy."""
from pyspark.sql import functions as F

from saleslens.catalog import pipelines as P
from saleslens.operators import quality as q
from saleslens.plans import fact as fact_plan
from saleslens.plans import model, profile
from saleslens.sources.fixtures import SalesTables

from conftest import SF_SMALL


def test_shares_sum_to_one(spark):
    t = SalesTables.of(spark, SF_SMALL)
    for df, col in ((P.profile_lines(t), "ProductID"), (t.header_hist, "CustomerID"), (t.header_hist, "SalesPersonID")):
        total = profile.relative_frequency(df, col, "x").agg(F.sum("Share")).first()[0]
        assert abs(total - 1.0) < 1e-9


def test_fact_plus_uncovered_equals_history_lines(spark):
    t = SalesTables.of(spark, SF_SMALL)
    assert q.overlapping_intervals(t.cost_history).count() == 0
    lines = fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                                        t.header_hist, ["OrderDate"])
    lost = q.uncovered_by_intervals(lines, t.cost_history, "ProductID", "OrderDate").count()
    assert P.sales_fact(t).count() + lost == t.detail_hist.count()
    assert lost > 0          # the fixtures drop some lines by design


def test_monitoring_keeps_every_snapshot_row(spark):
    t = SalesTables.of(spark, SF_SMALL)
    snap = P.snapshot_table(spark, t)
    from saleslens.plans import monitoring as mon
    out = mon.action_monitoring(snap, P.current_pairs(t, P.AS_OF), P.AS_OF)
    assert out.count() == snap.count()


def test_open_latest_twice_equals_once(spark):
    t = SalesTables.of(spark, SF_SMALL)
    once = model.open_latest(t.cost_history_raw)
    twice = model.open_latest(once)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    # exactly one open interval per product
    assert once.where(F.col("EndDate").isNull()).groupBy("ProductID").count().where("count <> 1").count() == 0


def test_history_shift_twice_equals_once(spark):
    t = SalesTables.of(spark, SF_SMALL)
    import datetime as dt
    a = model.shift_history(t.cost_history_raw, t.header_all, dt.date(2026, 1, 1))
    b = model.shift_history(t.cost_history_raw, t.header_all, dt.date(2026, 1, 1))
    assert a.exceptAll(b).count() == 0
