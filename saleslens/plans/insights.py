"""Analyses the reference README promises without code.

Definitions are ours (SURVEY §2.10). Every one is aggregate-first: the large
line-level data is reduced with partial aggregation before it meets dimensions
or an ordering, and global orderings use the distributed operators in
``operators.windows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from saleslens.functions.dates import GROWTH_FACTOR, as_date, days_in_prior_year, month_start, year_start
from saleslens.functions.money import SUM_MONEY
from saleslens.operators.aggregates import exact_percentiles
from saleslens.operators.limits import Order, limits, reached, tiles
from saleslens.operators.windows import global_row_number, global_running_sum

# ABC thresholds on the cumulative revenue share (percent).
ABC_A_PCT = 80
ABC_B_PCT = 95


def revenue_margin(fact: DataFrame, dim_product: DataFrame, territory: DataFrame) -> DataFrame:
    """Revenue, margin and margin % by year, quarter, month x country x category."""
    per = (fact.groupBy(month_start("OrderDate").alias("m"), "ProductID", "TerritoryID")
               .agg(F.sum("LineTotal").alias("rev"), F.sum("ProductMargin").alias("mar")))
    p = dim_product.select("ProductID", "Category")
    t = territory.select("TerritoryID", F.col("Name").alias("Country"))
    g = (per.join(p, "ProductID").join(t, "TerritoryID")
            .groupBy(F.year("m").alias("Year"), F.quarter("m").alias("Quarter"), F.month("m").alias("Month"),
                     "Country", "Category")
            .agg(F.sum("rev").cast(SUM_MONEY).alias("Revenue"), F.sum("mar").cast(SUM_MONEY).alias("Margin")))
    return g.withColumn("MarginPct", F.col("Margin").cast("double") /
                        F.nullif(F.col("Revenue").cast("double"), F.lit(0.0)))


def hierarchy_rollup(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Revenue and margin with subtotals category -> subcategory -> product (ROLLUP)."""
    per = fact.groupBy("ProductID").agg(F.sum("LineTotal").alias("rev"), F.sum("ProductMargin").alias("mar"))
    j = per.join(dim_product, "ProductID")
    return (j.rollup("Category", "Subcategory", "Product")
             .agg(F.grouping_id().alias("Level"), F.sum("rev").cast(SUM_MONEY).alias("Revenue"),
                  F.sum("mar").cast(SUM_MONEY).alias("Margin")))


def customer_rfm(header: DataFrame, detail: DataFrame, customer: DataFrame, as_of) -> DataFrame:
    """Recency / frequency / value per customer with quintile scores (5 = best) and customer type."""
    value = detail.groupBy("SalesOrderID").agg(F.sum("LineTotal").alias("v"))
    orders = header.select("SalesOrderID", "CustomerID", "OrderDate").join(value, "SalesOrderID", "left")
    per = orders.groupBy("CustomerID").agg(
        F.datediff(as_date(as_of), F.max("OrderDate")).alias("RecencyDays"),
        F.count(F.lit(1)).alias("Frequency"),
        F.coalesce(F.sum("v"), F.lit(0)).cast(SUM_MONEY).alias("Value"))
    kind = customer.select("CustomerID", F.when(F.col("StoreID").isNotNull(), F.lit("Store"))
                                          .otherwise(F.lit("Individual")).alias("CustomerType"))
    # one row per customer, written once to the checkpoint folder: the passes for the quintiles' limits read it
    per = per.join(kind, "CustomerID").checkpoint(eager=True)
    cid = F.col("CustomerID")
    per = tiles(per, {"R": (-F.col("RecencyDays"), cid), "F": (F.col("Frequency"), cid),
                      "M": (_units(F.col("Value")), cid)}, 5)
    return per.select("CustomerID", "CustomerType", "RecencyDays", "Frequency", "Value", "R", "F", "M")


def _units(money):
    """An amount with four decimals as a whole number."""
    return (money * 10_000).cast("decimal(38,0)")


def product_abc(fact: DataFrame) -> DataFrame:
    """ABC class by cumulative revenue share: A up to 80 %, B up to 95 %, C beyond."""
    per = fact.groupBy("ProductID").agg(F.sum("LineTotal").cast(SUM_MONEY).alias("Revenue"))
    total = per.select(F.sum("Revenue")).scalar()
    run = global_running_sum(per, [F.col("Revenue").desc(), F.col("ProductID").asc()], "Revenue", "CumRevenue")
    cum = F.col("CumRevenue")
    cls = (F.when(cum * 100 <= total * ABC_A_PCT, F.lit("A"))
            .when(cum * 100 <= total * ABC_B_PCT, F.lit("B")).otherwise(F.lit("C")))
    return run.select("ProductID", "Revenue", cum.cast(SUM_MONEY).alias("CumRevenue"), cls.alias("Class"))


def product_classes(fact: DataFrame) -> DataFrame:
    """D7's classes alone: the products at which the cumulative share passes 80 and 95 % are found by value histograms, so
    the products are not sorted. The total revenue must not be negative."""
    per = fact.groupBy("ProductID").agg(F.sum("LineTotal").cast(SUM_MONEY).alias("Revenue")).checkpoint(eager=True)
    total = per.agg(F.sum(_units(F.col("Revenue")))).first()[0] or 0
    # In hundredths of the units, so that the shares of the total are whole.
    order = Order(-_units(F.col("Revenue")), F.col("ProductID"), (total * ABC_A_PCT, total * ABC_B_PCT))
    found = limits(per, [order], _units(F.col("Revenue")) * 100)[0]
    cls = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), reached(order, found) + 1)
    return per.select("ProductID", "Revenue", cls.alias("Class"))


def cohort_retention(header: DataFrame) -> DataFrame:
    """First-order-month cohorts; active customers and retention by month offset."""
    act = header.select("CustomerID", month_start("OrderDate").alias("m")).distinct()
    first = act.groupBy("CustomerID").agg(F.min("m").alias("Cohort"))
    off = ((F.year("m") - F.year("Cohort")) * 12 + F.month("m") - F.month("Cohort")).alias("MonthOffset")
    j = act.join(first, "CustomerID").select("CustomerID", "Cohort", off)
    g = j.groupBy("Cohort", "MonthOffset").agg(F.count(F.lit(1)).alias("ActiveCustomers"))
    size = first.groupBy("Cohort").agg(F.count(F.lit(1)).alias("CohortSize"))
    return (g.join(size, "Cohort")
             .select(F.col("Cohort").alias("CohortMonth"), "MonthOffset", "ActiveCustomers", "CohortSize",
                     (F.col("ActiveCustomers").cast("double") / F.col("CohortSize")).alias("RetentionRate")))


def repurchase_timing(header: DataFrame, customer: DataFrame) -> DataFrame:
    """Days between a customer's consecutive order dates; mean, median, P90 per customer type.

    The lag runs per customer over *distinct order dates*, so a customer's
    partition holds at most one row per calendar day, whatever its order volume.
    """
    days = header.select("CustomerID", "OrderDate").distinct()
    w = Window.partitionBy("CustomerID").orderBy("OrderDate")
    gaps = days.select("CustomerID", F.datediff("OrderDate", F.lag("OrderDate").over(w)).alias("Gap")) \
               .where(F.col("Gap").isNotNull())
    kind = customer.select("CustomerID", F.when(F.col("StoreID").isNotNull(), F.lit("Store"))
                                          .otherwise(F.lit("Individual")).alias("Segment"))
    g = gaps.join(kind, "CustomerID")
    s = exact_percentiles(g, ["Segment"], "Gap", {"median": "0.5", "p90": "0.9"}, mean="mean")
    n = g.groupBy("Segment").agg(F.count(F.lit(1)).alias("Gaps"))
    return s.join(n, "Segment").select("Segment", "Gaps", F.round("mean", 6).alias("MeanGap"),
                                       F.col("median").cast("double").alias("MedianGap"),
                                       F.col("p90").cast("double").alias("P90Gap"))


def order_main_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Each order's category with the largest revenue (ties: smallest name; no category = 'NONE')."""
    c = dim_product.select("ProductID", F.coalesce("Category", F.lit("NONE")).alias("Category"))
    per = fact.join(c, "ProductID").groupBy("SalesOrderID", "CustomerID", "OrderDate", "Category") \
              .agg(F.sum("LineTotal").alias("rev"))
    return per.groupBy("SalesOrderID", "CustomerID", "OrderDate").agg(
        F.min_by("Category", F.struct((-F.col("rev")).alias("r"), F.col("Category").alias("c"))).alias("Category"))


def purchase_sequence(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Nth order per customer and category -> next-order category transitions with shares.

    The nth order comes from a distributed global row number minus the
    customer's first row number (a partially aggregated MIN), so a customer with
    a very large number of orders is spread over many tasks; the next order is an
    equi-join on (customer, n + 1).
    """
    orders = order_main_category(fact, dim_product)
    ranked = global_row_number(orders, [F.col("CustomerID"), F.col("OrderDate"), F.col("SalesOrderID")], "__g")
    first = ranked.groupBy("CustomerID").agg(F.min("__g").alias("__g0"))
    nth = ranked.join(first, "CustomerID").select("CustomerID", "Category",
                                                  (F.col("__g") - F.col("__g0") + 1).alias("Nth"))
    nxt = nth.select("CustomerID", (F.col("Nth") - 1).alias("Nth"), F.col("Category").alias("NextCategory"))
    trans = nth.join(nxt, ["CustomerID", "Nth"]).groupBy("Category", "NextCategory") \
               .agg(F.count(F.lit(1)).alias("Transitions"))
    from_total = Window.partitionBy("Category")   # over the aggregated category pairs only
    return trans.withColumn("Share", F.col("Transitions").cast("double") / F.sum("Transitions").over(from_total))


def day_by_day(fact: DataFrame, start, end, goal_as_of) -> DataFrame:
    """Daily revenue from ``start`` to ``end`` on a gap-free calendar, cumulative revenue vs the
    cumulative daily goal (prior-year revenue / days in prior year x growth, per day)."""
    spark = fact.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(as_date(start), as_date(end))).alias("Date"))
    daily = (fact.where((F.col("OrderDate") >= as_date(start)) & (F.col("OrderDate") <= as_date(end)))
                 .groupBy(F.col("OrderDate").alias("Date")).agg(F.sum("LineTotal").alias("rev")))
    y0, y1 = year_start(goal_as_of), year_start(goal_as_of, 1)
    prev = fact.where((F.col("OrderDate") >= y1) & (F.col("OrderDate") < y0)) \
               .select(F.sum("LineTotal").cast("double")).scalar()
    per_day = prev / F.nullif(days_in_prior_year(goal_as_of), F.lit(0)) * F.lit(float(GROWTH_FACTOR))
    w = Window.orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # one row per day
    out = days.join(daily, "Date", "left").select(
        "Date", F.coalesce("rev", F.lit(0).cast("decimal(19,4)")).cast(SUM_MONEY).alias("Revenue"))
    out = out.withColumn("CumRevenue", F.sum("Revenue").over(w).cast(SUM_MONEY)) \
             .withColumn("DayIndex", F.row_number().over(Window.orderBy("Date")))
    return out.withColumn("CumGoal", per_day * F.col("DayIndex")) \
              .withColumn("Gap", F.col("CumRevenue").cast("double") - F.col("CumGoal"))
