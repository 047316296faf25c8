"""Exact percentiles, profile statistics and distributed global-order operators."""
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saleslens.operators.aggregates import exact_percentiles
from saleslens.operators.windows import global_ntile, global_row_number, global_running_sum
from saleslens.plans import profile


def _exact(vals, p):
    v = sorted(vals)
    pos = Fraction(len(v) - 1) * Fraction(p)
    lo = int(pos)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (pos - lo) * (v[hi] - v[lo])


def test_exact_percentiles_match_rational_reference(spark):
    rnd = random.Random(7)
    rows = [(k, rnd.randint(1, 50)) for k in range(40) for _ in range(rnd.randint(1, 30))]
    rows += [(99, 7)] * 5000 + [(99, 8)]          # one hot key: its state is a 2-row histogram
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: (r.p10, r.p90, r.m) for r in
           exact_percentiles(df, ["k"], "v", {"p10": "0.1", "p90": "0.9"}, mean="m").collect()}
    by = {}
    for k, v in rows:
        by.setdefault(k, []).append(v)
    for k, vals in by.items():
        p10, p90, m = got[k]
        assert Fraction(str(p10)) == _exact(vals, "0.1")
        assert Fraction(str(p90)) == _exact(vals, "0.9")
        assert abs(m - sum(vals) / len(vals)) < 1e-9


def test_known_interpolation_cases(spark):
    df = spark.createDataFrame([(1, x) for x in (1, 2, 3, 10)] + [(2, x) for x in (5, 10, 14, 26, 29, 29, 39)],
                               "k int, v int")
    got = {r.k: (float(r.p10), float(r.p90)) for r in
           exact_percentiles(df, ["k"], "v", {"p10": "0.1", "p90": "0.9"}).collect()}
    assert got[1] == (1.3, 7.9) and got[2][1] == 33.0      # binary doubles give 33.000000000000004 here


def test_single_line_product_std_defaults_to_one(spark):
    lines = spark.createDataFrame([(1, 5), (2, 3), (2, 7)], "ProductID long, OrderQty smallint")
    r = profile.product_spread(lines).first()
    # product 1: mean 5, std NULL -> 1 ; product 2: mean 5, std 2.828427 -> mean of stds
    assert r.product_mean_avg == 5.0 and abs(r.product_std_avg - (1 + 2 ** 1.5) / 2) < 1e-6


def test_price_moments_defaults_when_empty(spark):
    ph = spark.createDataFrame([(1, None, 0.0)], "ProductID long, EndDate date, ListPrice double")
    r = profile.price_moments(ph).first()
    assert (r.price_mean, r.price_std) == (100.0, 50.0)


def test_global_order_operators_match_single_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.randint(0, 20)) for i in range(997)], "id long, v long").repartition(7)
    order = [F.col("v").desc(), F.col("id")]
    w = Window.orderBy(*order)
    want = {r.id: (r.rn, r.nt, r.rs) for r in df.select(
        "id", F.row_number().over(w).alias("rn"), F.ntile(5).over(w).alias("nt"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs")).collect()}
    rn = {r.id: r.rn for r in global_row_number(df, order).collect()}
    nt = {r.id: r.nt for r in global_ntile(df, order, 5, "nt").collect()}
    rs = {r.id: r.running for r in global_running_sum(df, order, "v").collect()}
    assert all(want[i] == (rn[i], nt[i], rs[i]) for i in want)


def test_tier_samples_come_from_the_histogram(spark):
    from saleslens.plans import profile
    cells = spark.createDataFrame([(1, 1, 2), (1, 5, 1), (2, 5, 3), (2, 9, 1), (3, 30, 4)], "ProductID long, OrderQty short, n long")
    offers = spark.createDataFrame(
        [(1, 0, None, 0.0), (2, 0, 4, .1), (3, 5, 9, .1), (4, 4, None, .2), (5, 10, 29, .1), (6, 9, 9, .1), (7, 12, 3, .1)],
        "SpecialOfferID int, MinQty int, MaxQty int, UnitPriceDiscount double")
    got = {r.SpecialOfferID: r.QtySamples for r in profile.tier_samples(cells, offers).collect()}
    assert got == {2: "1:2", 3: "5:4,9:1", 4: "5:4,9:1,30:4", 5: "", 6: "9:1", 7: ""}
    none = profile.tier_samples(cells, offers.where("UnitPriceDiscount = 0"))
    assert none.count() == 0
    empty = profile.tier_samples(cells.limit(0), offers).collect()
    assert {r.QtySamples for r in empty} == {""} and len(empty) == 6
    samples = {r.ProductID: r.QtySamples for r in profile.collect_samples(cells, "ProductID").collect()}
    assert samples == {1: "1:2,5:1", 2: "5:3,9:1", 3: "30:4"}


def test_profile_reads_the_lines_once(spark):
    from saleslens.plans import profile
    lines = spark.sql(
        "SELECT * FROM VALUES (DATE '2000-01-03', 1L, 2S, 10L, 5.0BD, 0.0BD), (DATE '2000-01-03', 1L, 4S, 11L, 5.0BD, 0.1BD), "
        "(DATE '2000-01-04', 2L, 2S, 10L, 7.0BD, 0.0BD) t(OrderDate, SalesOrderID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount)")
    hist = profile.profile_histogram(lines)
    plan = hist._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Expand") == 1
    assert {(r.part, r.n, r.qty) for r in hist.where("part = 'orders'").collect()} == {("orders", 2, 6), ("orders", 1, 2)}
    header = spark.createDataFrame([(1, None), (1, 5), (2, 5)], "CustomerID long, SalesPersonID long")
    prices = spark.sql("SELECT DATE '2000-01-01' AS StartDate, CAST(NULL AS DATE) AS EndDate, 3.0BD AS ListPrice")
    got = {(r.Metric, r.Key): r.Value for r in profile.history_profile(hist.checkpoint(), header, prices).collect()}
    assert got["daily_qty", "2000-01-03"] == 6 and got["daily_orders", "2000-01-04"] == 1
    assert got["product_share", "10"] == pytest.approx(2 / 3, abs=1e-9) and got["salesperson_share", "5"] == 1
    assert got["describe_UnitPrice_p50", None] == 5 and got["describe_OrderQty_std", None] == pytest.approx(1.154701)
    assert got["product_p90", "11"] == 4 and got["lines_p90", None] == 2 and got["price_std", None] == 0
