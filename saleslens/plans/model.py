"""Database build as Spark jobs: timeline shift (W1-W3), open latest interval
(W4-W5) and the reporting dimensions (W6-W9).

Every step reads the immutable source frames and derives the target, so
running it twice gives the same table (the reference's in-place UPDATEs were not
idempotent).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.dates import as_date, month_start, quarter_start, shift_date
from saleslens.functions.text import full_name

# The reporting calendar the dashboards use.
CALENDAR_START = dt.date(2011, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)


def max_order_date(header: DataFrame):
    """Scalar MAX(OrderDate) as a lazy scalar subquery (one value, no join)."""
    return header.select(F.max(F.col("OrderDate").cast("date"))).scalar()


def shift_orders(header_src: DataFrame, as_of) -> DataFrame:
    """Move order, due and ship dates so the latest order lands on ``as_of``."""
    anchor = max_order_date(header_src)
    out = header_src
    for c in ("OrderDate", "DueDate", "ShipDate"):
        out = out.withColumn(c, shift_date(c, anchor, as_of))
    return out.withColumn("modified_date", as_date(as_of))


def shift_history(history_src: DataFrame, header_src: DataFrame, as_of) -> DataFrame:
    """Shift validity intervals with the same anchor as the orders."""
    anchor = max_order_date(header_src)
    return (history_src.withColumn("StartDate", shift_date("StartDate", anchor, as_of))
                       .withColumn("EndDate", shift_date("EndDate", anchor, as_of))
                       .withColumn("modified_date", as_date(as_of)))


def open_latest(history: DataFrame, key: str = "ProductID", start: str = "StartDate",
                end: str = "EndDate") -> DataFrame:
    """The interval with the latest start per key gets an open (NULL) end.

    Aggregate-then-join instead of a window: the per-key maximum is computed with
    map-side partial aggregation, so a key holding a large share of the rows is
    never buffered in one task; the join back is an equi-join on a unique side.
    """
    latest = history.groupBy(key).agg(F.max(start).alias("__latest"))
    cols = [F.when(F.col(start) == F.col("__latest"), F.lit(None).cast("date"))
             .otherwise(F.col(end)).alias(end) if c == end else F.col(c) for c in history.columns]
    return history.join(latest, key).select(*cols)


def dim_customer(customer: DataFrame, store: DataFrame, person: DataFrame) -> DataFrame:
    """Store customers UNION ALL individual customers.

    A customer that is both store and person appears twice, as in the reference;
    dq_unique_key reports it.
    """
    stores = (customer.join(store, customer.StoreID == store.BusinessEntityID)
                      .where(store.Name.isNotNull())
                      .select(customer.CustomerID, store.Name.alias("CustomerName"),
                              F.lit("Store").alias("CustomerType")))
    people = (customer.join(person, customer.PersonID == person.BusinessEntityID)
                      .where(person.FirstName.isNotNull() & person.LastName.isNotNull())
                      .select(customer.CustomerID, full_name(person.FirstName, person.LastName).alias("CustomerName"),
                              F.lit("Individual").alias("CustomerType")))
    return stores.unionByName(people)


def dim_product(product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """Product -> subcategory -> category, outer on both steps."""
    sc = subcategory.select("ProductSubcategoryID", "ProductCategoryID", F.col("Name").alias("Subcategory"))
    cat = category.select("ProductCategoryID", F.col("Name").alias("Category"))
    return (product.select("ProductID", F.col("Name").alias("Product"), "ProductSubcategoryID")
                   .join(sc, "ProductSubcategoryID", "left")
                   .join(F.broadcast(cat), "ProductCategoryID", "left")
                   .select("ProductID", "Product", "Subcategory", "Category"))


def calendar_days(start, end, source: DataFrame | None = None) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, via sequence + explode.

    ``start``/``end`` may be literals or aggregate columns over ``source``.
    """
    if source is None:
        from pyspark.sql import SparkSession
        source = SparkSession.getActiveSession().range(1)
        base = source.select(as_date(start).alias("s"), as_date(end).alias("e"))
    else:
        base = source.agg(start.alias("s"), end.alias("e"))
    return base.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("Date"))


def dim_calendar(days: DataFrame) -> DataFrame:
    """Year, month, quarter, quarter start, month start per day."""
    d = F.col("Date")
    return days.select(d, F.year(d).alias("Year"), F.month(d).alias("Month"), F.quarter(d).alias("Quarter"),
                       quarter_start(d).alias("QuarterStart"), month_start(d).alias("MonthStart"))


def calendar_for_orders(header: DataFrame) -> DataFrame:
    """W8 over the whole years the order history covers."""
    od = F.col("OrderDate")
    days = calendar_days(F.make_date(F.year(F.min(od)), F.lit(1), F.lit(1)),
                         F.make_date(F.year(F.max(od)), F.lit(12), F.lit(31)), header)
    return dim_calendar(days)


def dim_territory(territory: DataFrame) -> DataFrame:
    """Territories used directly."""
    return territory.select("TerritoryID", "Name", "GroupName")
