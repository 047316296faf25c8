"""The margin fact -- one row per order line that has a cost valid on its order date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.money import margin, margin_pct
from saleslens.operators.joins import bucketed_interval_join, hot_keys, interval_join, small_side

HEADER_COLS = ["OrderDate", "DueDate", "ShipDate", "OnlineOrderFlag", "CustomerID",
               "SalesPersonID", "TerritoryID", "modified_date"]
DETAIL_COLS = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice",
               "UnitPriceDiscount", "LineTotal", "SpecialOfferID"]
FACT_COLS = DETAIL_COLS + ["OrderDate", "DueDate", "ShipDate", "OnlineOrderFlag", "CustomerID",
                           "StandardCost", "SalesPersonID", "TerritoryID", "modified_date",
                           "ProductMargin", "ProductMarginPct"]


def lines_with_header(detail: DataFrame, header: DataFrame, header_cols=None) -> DataFrame:
    """Each line gets its order's header attributes (inner equi-join on SalesOrderID)."""
    h = header.select("SalesOrderID", *(header_cols or HEADER_COLS))
    return detail.join(h, "SalesOrderID")


def costed_lines(lines: DataFrame, detail: DataFrame, header: DataFrame, cost_history: DataFrame,
                 right_cols: list[str], by_month: bool) -> DataFrame:
    """J2 on lines that carry their OrderDate; ``by_month`` deals the lines of hot products by month as well."""
    if not by_month:
        costs = small_side(cost_history.select("ProductID", "StartDate", "EndDate", *right_cols))
        return interval_join(lines, costs, key="ProductID", point="OrderDate", right_cols=right_cols)
    span = header.select(F.struct(F.min("OrderDate").alias("since"), F.max("OrderDate").alias("until"))).scalar()
    return bucketed_interval_join(lines, cost_history, "ProductID", "OrderDate", hot_keys(detail, "ProductID"),
                                  span["since"], span["until"], right_cols=right_cols)


def fact_sales_margin(detail: DataFrame, header: DataFrame, cost_history: DataFrame, by_month: bool = False) -> DataFrame:
    """J1 + J2 + F2 + F3.

    Plan: detail and header meet on SalesOrderID (sort-merge, or co-located when
    both are bucketed on it); the result meets the cost history on ProductID with
    the date range as residual. The cost history is one row per product and
    interval: it is measured, and broadcast if small, so that the lines aren't shuffled again; otherwise it is a
    second sort-merge join whose hot products AQE splits. ``by_month`` is for histories too large to be
    broadcast: products with many lines are joined month by month, for one more count of the lines by product.
    """
    lines = lines_with_header(detail.select(*DETAIL_COLS), header)
    costed = costed_lines(lines, detail, header, cost_history, ["StandardCost"], by_month)
    m = margin("LineTotal", "StandardCost", "OrderQty")
    return (costed.select(*[c for c in FACT_COLS if c not in ("ProductMargin", "ProductMarginPct")],
                          m.alias("ProductMargin"))
                  .withColumn("ProductMarginPct", margin_pct("ProductMargin", "LineTotal")))
