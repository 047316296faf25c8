"""Streaming jobs over several runs."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from saleslens.plans import daily
from saleslens.streaming import daily as sd

EVENT = "event_id long, ts timestamp_ntz, event_type string, value double"


@pytest.fixture()
def arrive(spark, work):
    """Events arrive as one file a call: (day, value), or None for a view."""
    src = work("events")
    ids = iter(range(1000))

    def land(*rows):
        data = [(next(ids), dt.datetime(2020, 1, d, 12), "purchase", v) for d, v in rows]
        data.append((next(ids), dt.datetime(2020, 1, 28), "view", 1.0))
        spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(src)
        return src
    return land


def totals(frame):
    return sorted((r.WindowStart.day, r.Revenue, r.Purchases) for r in frame.collect())


def test_late_rows_inside_and_beyond_the_watermark(spark, arrive, work):
    sink, ckpt = work("sink"), work("ckpt")
    src = arrive((10, 10.0), (5, 5.0))
    days, late = sd.run_daily_revenue(spark, src, sink, ckpt, "3 days")
    assert totals(days) == [(5, 5.0, 1), (10, 10.0, 1)] and late.count() == 0
    arrive((9, 2.0), (5, 0.5), (6, 7.0), (7, 1.0), (10, 1.0), (9, None))     # the watermark is noon of day 7
    days, late = sd.run_daily_revenue(spark, src, sink, ckpt, "3 days")
    assert totals(days) == [(5, 5.0, 1), (7, 1.0, 1), (9, 2.0, 2), (10, 11.0, 2)]
    assert sorted((r.ts.day, r.value) for r in late.collect()) == [(5, 0.5), (6, 7.0)]
    assert totals(sd.all_revenue(days, late)) == [(5, 5.5, 2), (6, 7.0, 1), (7, 1.0, 1), (9, 2.0, 2), (10, 11.0, 2)]


def test_killed_run_resumes_from_its_state(spark, arrive, work, monkeypatch):
    sink, ckpt = work("sink"), work("ckpt")
    src = arrive((10, 10.0), (10, 1.0))
    sd.run_daily_revenue(spark, src, sink, ckpt)
    arrive((10, 5.0), (1, 3.0))
    once = sd._run_once

    def dies(stream, checkpoint, each):
        def batch(df, epoch, query):
            each(df, epoch, query)
            raise RuntimeError("lost")
        return once(stream, checkpoint, batch)
    monkeypatch.setattr(sd, "_run_once", dies)
    with pytest.raises(Exception, match="lost"):
        sd.run_daily_revenue(spark, src, sink, ckpt)
    monkeypatch.setattr(sd, "_run_once", once)
    days, late = sd.run_daily_revenue(spark, src, sink, ckpt)
    assert totals(days) == [(10, 16.0, 3)] and totals(sd.all_revenue(days, late)) == [(1, 3.0, 1), (10, 16.0, 3)]


HEADER = ("SalesOrderID long, OrderDate date, DueDate date, ShipDate date, OnlineOrderFlag boolean, CustomerID long, "
          "SalesPersonID long, TerritoryID int, SubTotal decimal(19,4), modified_date date")
DETAIL = ("SalesOrderID long, SalesOrderDetailID long, OrderQty short, ProductID long, UnitPrice decimal(19,4), "
          "UnitPriceDiscount decimal(19,4), LineTotal decimal(19,4), SpecialOfferID int")


@pytest.fixture()
def shop(spark, work):
    """A store with order 1 in its history, and a function that stages orders and lines: (order, day, processed), (order, line)."""
    d = dt.date(2020, 1, 1)
    from decimal import Decimal as D
    header = spark.createDataFrame([(1, d, d, d, True, 1, None, 1, D(3), d)], HEADER)
    detail = spark.createDataFrame([(1, 11, 1, 1, D(3), D(0), D(3), 1)], DETAIL)
    store = daily.TableStore(spark, work("store"), {"header": header, "detail": detail})
    staging = work("staging")

    def stage(orders, lines, day=2):
        day = dt.date(2020, 1, day)
        o = spark.createDataFrame([(i, day, day, day, True, 1, None, 1, False, day) for i in orders],
                                  HEADER.replace("SubTotal decimal(19,4)", "processed boolean"))
        x = spark.createDataFrame([(i, n, 2, 1, 1, D(5), D("0.1"), D(9), day) for i, n in lines],
                                  "SalesOrderID long, SalesOrderDetailID long, OrderQty short, ProductID long, SpecialOfferID int, "
                                  "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), LineTotal decimal(19,4), modified_date date")
        sd.stage_batch(o, x, staging)
        return staging
    return store, stage


def held(store, table="header", col="SalesOrderID"):
    return sorted(r[0] for r in store.read(table).select(col).collect())


def test_lines_of_a_later_run_are_loaded(spark, shop, work):
    store, stage = shop
    ckpt = work("ckpt")
    staging = stage([2, 3, 1], [(2, 21), (2, 22), (4, 41)])
    sd.stream_daily_load(spark, store, staging, ckpt)
    assert held(store) == [1, 2] and held(store, "detail", "SalesOrderDetailID") == [11, 21, 22]
    assert held(store, "waiting_orders") == [3] and held(store, "waiting_lines") == [4]
    stage([4], [(3, 31), (2, 23), (1, 12)])
    sd.stream_daily_load(spark, store, staging, ckpt)
    assert held(store) == [1, 2, 3, 4] and held(store, "detail", "SalesOrderDetailID") == [11, 21, 22, 31, 41]
    assert held(store, "late_lines", "SalesOrderDetailID") == [12, 23]
    assert held(store, "waiting_orders") == held(store, "waiting_lines") == []
    subtotal = dict(store.read("header").select("SalesOrderID", F.col("SubTotal").cast("double")).collect())
    assert subtotal == {1: 3.0, 2: 18.0, 3: 9.0, 4: 9.0}
    sd.stream_daily_load(spark, store, staging, work("replay"))
    assert held(store) == [1, 2, 3, 4] and held(store, "detail", "SalesOrderDetailID") == [11, 21, 22, 31, 41]


def test_checkpoints_with_the_same_name_are_two_queries(spark, shop, work):
    store, stage = shop
    staging = stage([2], [(2, 21)])
    sd.stream_daily_load(spark, store, staging, f"{work('one')}/ckpt")
    stage([3], [(3, 31)])
    sd.stream_daily_load(spark, store, staging, f"{work('two')}/ckpt")
    assert held(store) == [1, 2, 3] and held(store, "detail", "SalesOrderDetailID") == [11, 21, 31]


def test_killed_load_is_resumed(spark, shop, work, monkeypatch):
    store, stage = shop
    ckpt = work("ckpt")
    staging = stage([2], [(2, 21)])
    monkeypatch.setattr(sd, "load_waiting", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sd.stream_daily_load(spark, store, staging, ckpt)
    assert held(store) == [1] and held(store, "waiting_orders") == [2]
    monkeypatch.undo()
    again = daily.TableStore(spark, store.root, {n: store.bases[n] for n in ("header", "detail")})
    sd.stream_daily_load(spark, again, staging, ckpt)
    assert held(again) == [1, 2] and held(again, "detail", "SalesOrderDetailID") == [11, 21]


def test_rows_that_wait_too_long_go_to_side_tables(spark, shop, work):
    store, stage = shop
    staging = stage([2], [(3, 31)], day=2)
    stage([4], [], day=20)
    sd.stream_daily_load(spark, store, staging, work("ckpt"), max_wait=10)
    assert held(store, "expired_orders") == [2] and held(store, "expired_lines") == [3]
    assert held(store, "waiting_orders") == [4] and held(store, "waiting_lines") == []
