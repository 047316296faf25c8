"""Quantile and share limits from histograms, against sorting."""
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleslens.operators.limits import BINS, Order, limits, reached, tile_ends, tiles
from saleslens.operators.windows import global_ntile
from saleslens.plans import insights

RNG = random.Random(11)
SHAPES = {
    "wide": [RNG.randrange(-10**14, 10**14) for _ in range(300)],
    "one value": [7] * 101,
    "a far value": [1] * 50 + [2] * 50 + [10**17],
    "neighbours far out": [10**16 + i % 9 for i in range(200)] + [-10**16],
    "more bins than rows": list(range(0, BINS * 40, BINS // 3)),
    "fewer rows than tiles": [5, 3, 5],
    "none": [],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_tiles_are_those_of_a_full_sort(spark, shape):
    rows = [(i * 10**9 if shape == "one value" else i, v) for i, v in enumerate(SHAPES[shape])]
    RNG.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, v long").withColumn("k0", F.lit("x")).repartition(3)
    up = sorted(rows, key=lambda r: (r[1], r[0]))
    down = sorted(rows, key=lambda r: (-r[1], r[0]))

    def want(order):
        ends = tile_ends(len(order), 5)
        return {r[0]: 1 + sum(n >= e for e in ends) for n, r in enumerate(order)}
    got = tiles(df, {"up": (F.col("v"), F.col("id")), "down": (-F.col("v"), F.col("id"))}, 5)
    assert got.columns == ["id", "v", "k0", "up", "down"]
    found = got.collect()
    assert len(found) == len(rows)
    assert {r.id: r.up for r in found} == want(up) and {r.id: r.down for r in found} == want(down)
    if rows:
        again = global_ntile(df, [F.col("v"), F.col("id")], 5, "t").collect()
        assert {r.id: r.t for r in again} == want(up)


def test_nulls_come_last_and_equal_rows_share_a_tile(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 5), (2, 6), (3, None), (None, 1)], "id int, v int")
    got = sorted(((r.v, r.id, r.t) for r in tiles(df, {"t": (F.col("v"), F.col("id"))}, 3).collect()), key=str)
    assert got == sorted([(1, None, 1)] + [(5, 1, 2)] * 3 + [(6, 2, 3), (None, 3, 3)], key=str)


def test_share_limits_are_those_of_a_running_sum(spark):
    rows = [(i, RNG.choice([0, 1, 5, 5, 10**12, RNG.randrange(10**9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, w long").repartition(4)
    total = sum(w for _, w in rows)
    amounts = (Decimal(0), Decimal(total) / 2, Decimal(total - 1), Decimal(total))
    order = Order(-F.col("w"), F.col("id"), amounts)
    found = limits(df, [order], F.col("w"))[0]
    want, run = [None] * 4, 0
    for i, w in sorted(rows, key=lambda r: (-r[1], r[0])):
        run += w
        for j, a in enumerate(amounts):
            if want[j] is None and run > a:
                want[j] = (-w, i)
    assert found == want and want[3] is None
    n = df.select(reached(order, found).alias("n")).groupBy().agg(F.sum("n")).first()[0]
    assert n == sum(sum((-w, i) >= x for x in want if x) for i, w in rows)


def test_classes_are_those_of_the_running_sum(spark):
    rows = [(i % 60, Decimal(RNG.randrange(0, 10**7)) / 100) for i in range(500)]
    fact = spark.createDataFrame(rows, "ProductID int, LineTotal decimal(19,4)")
    want = {r.ProductID: (r.Revenue, r.Class) for r in insights.product_abc(fact).collect()}
    assert {r.ProductID: (r.Revenue, r.Class) for r in insights.product_classes(fact).collect()} == want
    assert {c for _, c in want.values()} == {"A", "B", "C"}
    assert insights.product_classes(fact.limit(0)).count() == 0


def test_no_sort_of_the_customers(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("v")).checkpoint()
    plan = tiles(df, {"t": (F.col("v"), F.col("id"))}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
