"""Quantiles from stored sketches against exact ranks."""
import datetime as dt
import random

from pyspark.sql import functions as F

from saleslens.operators import sketches
from saleslens.sources import partitioned

RNG = random.Random(3)
DAY = dt.date(2001, 1, 1)


def lines(spark, n=60_000):
    """Half of the lines are of one product; small products have fewer lines than a sketch holds."""
    rows = []
    for i in range(n):
        p = 1 if i % 2 else RNG.randrange(2, 200)
        rows.append((DAY + dt.timedelta(days=i * 20 // n), i // 3, p, None if i % 997 == 0 else RNG.randrange(1, 30_000)))
    return rows, spark.createDataFrame(rows, "OrderDate date, SalesOrderID int, ProductID int, OrderQty smallint").repartition(6)


def within(values, got, p):
    """Whether a value's ranks hold the share p within the bound."""
    n, e = len(values), sketches.rank_error()
    return sum(v < got for v in values) / n - e <= p <= sum(v <= got for v in values) / n + e


def test_a_day_is_added_and_ranks_keep_the_bound(spark, work):
    rows, df = lines(spark)
    last = max(r[0] for r in rows)
    path = partitioned.write_partitioned(sketches.product_days(df.where(F.col("OrderDate") < last)), work("days"), "OrderDate")
    new = sketches.product_days(df.where(F.col("OrderDate") == last))
    for _ in range(2):                                    # the second time replaces the day by itself
        partitioned.replace_parts(new, path, "OrderDate")
    days = partitioned.read_partitioned(spark, path, new.schema)
    of = {}
    for _, _, p, q in rows:
        if q is not None:
            of.setdefault(p, []).append(q)
    got = sketches.product_quantiles(days).collect()
    assert {r.ProductID for r in got} == set(of)
    for r in got:
        v = sorted(of[r.ProductID])
        assert r.Lines == len(v) and abs(r.MeanQty - sum(v) / len(v)) < 1e-9
        assert within(v, r.P10, 0.1) and within(v, r.P90, 0.9)
        if len(v) <= sketches.K:
            assert (r.P10, r.P90) == (v[-(-len(v) // 10) - 1], v[-(-9 * len(v) // 10) - 1])
    every = [q for v in of.values() for q in v]
    g = sketches.global_quantiles(days).first()
    assert g.Lines == len(every) and within(every, g.P10, 0.1) and within(every, g.P90, 0.9)


def test_order_sizes_from_days(spark):
    rows, df = lines(spark, 30_000)
    per = {}
    for d, o, _, q in rows:
        n, u = per.get((d, o), (0, 0))
        per[d, o] = (n + 1, u + (q or 0))
    days = sketches.order_days(df)
    assert days.count() == 20
    r = sketches.order_size_profile(days).first()
    assert r.Orders == len(per) and abs(r.lines_mean - len(rows) / len(per)) < 1e-5
    units = [u for _, u in per.values()]
    assert within(units, r.qty_p10, 0.1) and within(units, r.qty_p90, 0.9)
    assert within([n for n, _ in per.values()], r.lines_p10, 0.1) and r.lines_p90 >= r.lines_p10


def test_nothing_to_sketch(spark):
    none = spark.createDataFrame([(DAY, 1, 1, None)], "OrderDate date, SalesOrderID int, ProductID int, OrderQty smallint")
    assert sketches.product_quantiles(sketches.product_days(none)).count() == 0
    assert sketches.global_quantiles(sketches.product_days(none)).count() == 0
    assert sketches.order_size_profile(sketches.order_days(none.limit(0))).count() == 0
    r = sketches.order_size_profile(sketches.order_days(none)).first()
    assert (r.Orders, r.lines_p10, r.lines_p90, r.qty_mean, r.qty_p10, r.qty_p90) == (1, 1, 1, None, 1, 1)
