"""Daily load guard and round trip, monitoring 0-vs-NULL, dimension duplicates."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleslens.catalog.pipelines import current_pairs, loaded_fact, staged_store
from saleslens.plans import daily, model
from saleslens.plans import monitoring as mon
from saleslens.sources.fixtures import SalesTables

from conftest import SF_SMALL


def test_same_batch_twice_raises_and_adds_nothing(spark, work):
    t = SalesTables(spark, SF_SMALL)
    store = staged_store(spark, t)
    daily.daily_load(store, "load1")
    n_h, n_d = store.read("header").count(), store.read("detail").count()
    # a second batch of the very same orders (un-flagged again) must be refused
    store.commit("unflag", replace={"orders_temp": store.read("orders_temp").withColumn("processed", F.lit(False))})
    for batch in ("load1", "load2"):
        with pytest.raises(daily.DuplicateLoadError):
            daily.daily_load(store, batch)
    assert (store.read("header").count(), store.read("detail").count()) == (n_h, n_d)


def test_orders_without_details_stay_unprocessed(spark, work):
    t = SalesTables(spark, SF_SMALL)
    store = staged_store(spark, t)
    before = {r.SalesOrderID: r.processed for r in store.read("orders_temp").collect()}
    with_lines = {r.SalesOrderID for r in store.read("daily_details_temp").select("SalesOrderID").distinct().collect()}
    daily.daily_load(store, "load")
    after = {r.SalesOrderID: r.processed for r in store.read("orders_temp").collect()}
    for oid, was in before.items():
        assert after[oid] == (was or oid in with_lines)


def test_roundtrip_restores_tables(spark, work):
    t = SalesTables(spark, SF_SMALL)
    store = staged_store(spark, t)
    daily.daily_load(store, "load")
    store = staged_store(spark, t, store.root)      # as another session would open it
    assert daily.daily_reset(store, "load") and not daily.daily_reset(store, "load")
    assert daily.table_differences(t.header_hist.select(*daily.HEADER_COLS), store.read("header")).count() == 0
    assert daily.table_differences(t.detail_hist.select(*daily.DETAIL_COLS), store.read("detail")).count() == 0
    assert daily.table_differences(t.orders_temp, store.read("orders_temp")).count() == 0


def test_load_that_fails_half_way_leaves_nothing_and_can_run_again(spark, work, monkeypatch):
    t = SalesTables(spark, SF_SMALL)
    whole = staged_store(spark, t)
    daily.daily_load(whole, "load")
    store = staged_store(spark, t)
    n_h = store.read("header").count()
    write = daily.TableStore._write

    def fail(self, name, *args):
        if name == "detail":
            raise OSError("lost")
        return write(self, name, *args)
    with monkeypatch.context() as m:
        m.setattr(daily.TableStore, "_write", fail)
        with pytest.raises(OSError):
            daily.daily_load(store, "load")
    store = staged_store(spark, t, store.root)
    assert store.read("header").count() == n_h and not store.has_batch("load")
    daily.daily_load(store, "load")
    for name in ("header", "detail", "orders_temp"):
        assert daily.table_differences(whole.read(name), store.read(name)).count() == 0


def test_monitoring_sees_orders_loaded_after_the_snapshot(spark):
    t = SalesTables(spark, SF_SMALL)
    as_of = dt.date(2001, 8, 1)
    before = current_pairs(t, as_of).agg(F.sum("CurrentRevenue")).first()[0]
    after = current_pairs(t, as_of, loaded_fact(spark, t)).agg(F.sum("CurrentRevenue")).first()[0]
    assert after > before


def test_monitoring_zero_vs_null(spark):
    t = SalesTables(spark, SF_SMALL)
    as_of = dt.date(2001, 8, 1)
    cur = current_pairs(t, as_of)
    some = cur.where(F.col("Subcategory").isNotNull()).orderBy("Country", "Subcategory").first()
    snap = spark.createDataFrame(
        [(dt.date(2001, 7, 1), some.Subcategory, some.Country, "High", None, None, None, None),
         (dt.date(2001, 7, 1), "NO-SUCH", "NOWHERE", "Low", None, None, None, None)],
        "SnapshotDate date, Subcategory string, Country string, PriorityType string, SnapshotRevenue decimal(18,2), "
        "PercCurrentSnapshotGoal decimal(18,4), DeltaCurrentSnapshotGoal decimal(18,2), "
        "CurrentSnapshotGoal decimal(18,2)")
    out = {r.Country: r for r in mon.action_monitoring(snap, cur, as_of).collect()}
    assert out["NOWHERE"].CurrentRevenue is None and out["NOWHERE"].CurrentGoalToDate is None
    assert out[some.Country].CurrentRevenue == some.CurrentRevenue
    # a pair whose sales are all in older years has 0 this year, not NULL
    old = current_pairs(t, dt.date(2030, 6, 1)).first()
    assert old.CurrentRevenue == Decimal("0E-4") or old.CurrentRevenue == 0


def test_customer_both_store_and_person_appears_twice(spark):
    t = SalesTables(spark, SF_SMALL)
    dim = model.dim_customer(t.customer_src, t.store, t.person)
    dup = dim.groupBy("CustomerID").count().where("count > 1").select("CustomerID").collect()
    assert dup and all(r.CustomerID % 30 == 0 for r in dup)


def test_timeline_shift_is_idempotent(spark):
    t = SalesTables(spark, SF_SMALL)
    a = model.shift_orders(t.header_all, dt.date(2026, 1, 1))
    b = model.shift_orders(t.header_all, dt.date(2026, 1, 1))
    assert a.exceptAll(b).count() == 0
    assert a.agg(F.max("OrderDate")).first()[0] == dt.date(2026, 1, 1)


def test_audit_counts_only_what_a_load_wrote(spark, work):
    t = SalesTables(spark, SF_SMALL)
    store = staged_store(spark, t)
    n_h, n_d = t.header_hist.count(), t.detail_hist.count()
    daily.daily_load(store, "one")
    first = {(r.TableName, r.Stage): r.Rows for r in daily.load_audit(store, "one").collect()}
    assert (first["header", "before"], first["detail", "before"]) == (n_h, n_d)
    assert first["detail", "after"] == store.read("detail").count() > n_d
    again = store.read("header").limit(3).withColumn("SalesOrderID", F.col("SalesOrderID") + 10**9)
    store.commit("two", append={"header": again})
    store.bases = {n: f.limit(0) for n, f in store.bases.items()}         # from here on a scan of the history would show
    second = {(r.TableName, r.Stage): r.Rows for r in daily.load_audit(store, "two").collect()}
    assert second["header", "before"] == first["header", "after"] == second["header", "after"] - 3
    assert second["detail", "before"] == second["detail", "after"] == first["detail", "after"]


def test_current_pairs_from_the_history_and_the_batch_are_those_of_the_loaded_tables(spark):
    from saleslens.catalog.pipelines import AS_OF, snapshot_and_current, snapshot_table
    t = SalesTables.of(spark, SF_SMALL)
    snapshot, current = snapshot_and_current(spark, t)
    assert sorted(map(str, current.collect())) == sorted(map(str, current_pairs(t, AS_OF, loaded_fact(spark, t)).collect()))
    assert sorted(map(str, snapshot.collect())) == sorted(map(str, snapshot_table(spark, t).collect()))
