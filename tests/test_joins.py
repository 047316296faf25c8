"""Interval join, coverage/overlap checks and offer matching on edge rows."""
import datetime as dt

from saleslens.operators import quality as q
from saleslens.operators.joins import interval_join
from saleslens.plans import profile

D = dt.date


def _lines(spark):
    rows = [(1, 10, D(2000, 1, 1)), (2, 10, D(2000, 6, 30)), (3, 10, D(2000, 7, 1)), (4, 10, D(2030, 1, 1)),
            (5, 20, D(2000, 3, 1)), (6, 30, D(1999, 1, 1))]
    return spark.createDataFrame(rows, "LineID int, ProductID long, OrderDate date")


def _costs(spark, overlap=False):
    rows = [(10, D(2000, 1, 1), D(2000, 6, 30), 1.0), (10, D(2000, 7, 1), None, 2.0),
            (20, D(2000, 1, 1), D(2000, 12, 31), 3.0), (30, D(2000, 1, 1), None, 4.0)]
    if overlap:
        rows.append((20, D(2000, 2, 1), D(2000, 4, 1), 5.0))
    return spark.createDataFrame(rows, "ProductID long, StartDate date, EndDate date, StandardCost double")


def test_interval_join_boundaries_open_end_and_loss(spark):
    out = interval_join(_lines(spark), _costs(spark), "ProductID", "OrderDate", right_cols=["StandardCost"])
    got = sorted((r.LineID, r.StandardCost) for r in out.collect())
    # start day, end day, next interval from end+1, open end far in the future; line 6 has no valid cost
    assert got == [(1, 1.0), (2, 1.0), (3, 2.0), (4, 2.0), (5, 3.0)]
    lost = q.uncovered_by_intervals(_lines(spark), _costs(spark), "ProductID", "OrderDate")
    assert [r.LineID for r in lost.collect()] == [6]


def test_overlap_duplicates_and_is_reported(spark):
    out = interval_join(_lines(spark), _costs(spark, overlap=True), "ProductID", "OrderDate",
                        right_cols=["StandardCost"])
    assert sorted(r.StandardCost for r in out.where("LineID = 5").collect()) == [3.0, 5.0]
    ov = q.overlapping_intervals(_costs(spark, overlap=True)).collect()
    assert [(r.ProductID, r.StartDate) for r in ov] == [(20, D(2000, 2, 1))]
    assert q.overlapping_intervals(_costs(spark)).count() == 0


def test_overlap_with_an_interval_that_is_not_the_direct_predecessor(spark):
    rows = [(1, D(2000, 1, 1), D(2000, 12, 31)), (1, D(2000, 2, 1), D(2000, 2, 2)), (1, D(2000, 6, 1), D(2000, 6, 30)),
            (1, D(2001, 1, 1), None), (1, D(2030, 1, 1), D(2030, 1, 2)), (2, D(2000, 3, 1), D(2000, 3, 2))]
    ov = q.overlapping_intervals(spark.createDataFrame(rows, "ProductID long, StartDate date, EndDate date")).collect()
    assert sorted(r.StartDate for r in ov) == [D(2000, 2, 1), D(2000, 6, 1), D(2030, 1, 1)]


OFFERS = "SpecialOfferID int, MinQty int, MaxQty int, UnitPriceDiscount decimal(10,4)"


def test_offer_best_match_and_fallbacks(spark):
    from decimal import Decimal as Dec
    offers = spark.createDataFrame([(1, 0, None, Dec("0")), (2, 11, 14, Dec("0.02")), (3, 11, 20, Dec("0.05")),
                                    (6, 61, None, Dec("0.2"))], OFFERS)
    lines = spark.createDataFrame([(1, 5), (2, 12), (3, 70), (4, -3)], "LineID int, OrderQty smallint")
    got = {r.LineID: r.SpecialOfferID for r in profile.assign_offers(lines, offers).collect()}
    # 12 matches 2 and 3: same MinQty, smaller MaxQty wins; -3 matches nothing -> first zero-discount offer
    assert got == {1: 1, 2: 2, 3: 6, 4: 1}
    no_zero = spark.createDataFrame([(2, 11, 14, Dec("0.02")), (6, 61, None, Dec("0.2"))], OFFERS)
    got2 = {r.LineID: r.SpecialOfferID for r in profile.assign_offers(lines, no_zero).collect()}
    # no zero-discount offer: the last offer in preference order (MinQty desc) = offer 2
    assert got2 == {1: 2, 2: 2, 3: 6, 4: 2}


def test_tier_profile_keeps_empty_tiers(spark):
    from decimal import Decimal as Dec
    offers = spark.createDataFrame([(1, 0, None, Dec("0")), (2, 0, 14, Dec("0.02")), (6, 61, None, Dec("0.2"))],
                                   OFFERS)
    lines = spark.createDataFrame([(1,), (14,), (15,)], "OrderQty smallint")
    got = {r.SpecialOfferID: (r.TierMin, r.HistoryLines, r.HasHistory)
           for r in profile.tier_profile(lines, offers).collect()}
    assert got == {2: (1, 2, True), 6: (61, 0, False)}


def _skewed(spark):
    """Lines of 60 months, half of them of product 1, and three intervals a product, one of them open."""
    from pyspark.sql import functions as F
    lines = spark.range(24_000).select(
        F.col("id").alias("LineID"), F.when(F.col("id") % 2 == 0, 1).otherwise(2 + F.col("id") % 97).cast("long").alias("ProductID"),
        F.date_add(F.lit(D(2000, 1, 1)), (F.xxhash64("id") % 913 + 913).cast("int")).alias("OrderDate"))
    edges = [(D(1990, 1, 1), D(2001, 6, 30)), (D(2001, 6, 1), D(2002, 3, 31)), (D(2002, 5, 1), None), (D(2090, 1, 1), None)]
    costs = spark.createDataFrame([(p, s, e, float(i)) for p in range(1, 100) if p != 7 for i, (s, e) in enumerate(edges)],
                                  "ProductID long, StartDate date, EndDate date, StandardCost double")
    return lines, costs


def _bucketed(lines, costs, unit="MONTH", hot=None):
    from pyspark.sql import functions as F
    from saleslens.operators.joins import bucketed_interval_join, hot_keys
    span = [lines.select(f("OrderDate")).scalar() for f in (F.min, F.max)]
    return bucketed_interval_join(lines, costs, "ProductID", "OrderDate", hot or hot_keys(lines, "ProductID"), *span,
                                  right_cols=["StandardCost"], unit=unit)


def test_bucketed_join_has_the_rows_of_the_interval_join(spark):
    lines, costs = _skewed(spark)
    lines = lines.unionByName(spark.createDataFrame([(-1, None, D(2000, 1, 1)), (-2, 1, None), (-3, 1, D(1980, 1, 1))], lines.schema))
    want = interval_join(lines, costs, "ProductID", "OrderDate", right_cols=["StandardCost"])
    for unit in ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR"):
        got = _bucketed(lines, costs, unit)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    nothing = _bucketed(lines, costs, hot=lines.select("ProductID").limit(0))
    assert nothing.count() == want.count()


def test_hot_product_is_spread_over_tasks(spark, monkeypatch):
    from statistics import median

    from pyspark.sql import functions as F

    from saleslens.operators import joins
    lines, costs = _skewed(spark)
    monkeypatch.setattr(joins, "HOT", 4)                       # only product 1 holds a fourth
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in zip(names, ("false", "8", "-1")):
            spark.conf.set(n, v)

        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = sizes(interval_join(lines, costs, "ProductID", "OrderDate", right_cols=["StandardCost"]))
        dealt = sizes(_bucketed(lines, costs))
        assert [r[0] for r in joins.hot_keys(lines, "ProductID").collect()] == [1]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert max(plain) > 3 * median(plain) and max(dealt) < 3 * median(dealt)


def test_a_side_is_hinted_only_if_its_measured_size_is_small(spark, monkeypatch):
    from pyspark.sql import functions as F
    from saleslens.operators import joins
    big = spark.range(1000).select(F.col("id"), F.lit("x").alias("t"))
    dim = spark.createDataFrame([(i, "é" * 100, None) for i in range(50)], "id long, name string, note string")
    assert joins.relation_bytes(dim) == 50 * (64 + 8 * 3) + 2 * 50 * 200
    assert joins.relation_bytes(dim.limit(0)) == 0
    assert joins.relation_bytes(dim.select(F.array("id").alias("a"))) is None

    def plan(side):
        return big.join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(joins.small_side(dim))
    assert "broadcast" not in plan(joins.small_side(dim.select("id", F.array("name").alias("a"))))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert "broadcast" not in plan(joins.small_side(dim))
