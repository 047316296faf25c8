"""Registered data-quality checks Q1-Q13."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslens.catalog import register
from saleslens.catalog import oracle_ctes as oc
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.catalog.pipelines import sales_fact  # noqa: F401  (keeps the model queries registered first)
from saleslens.operators import quality as q
from saleslens.plans import fact as fact_plan
from saleslens.plans import model
from saleslens.sources.fixtures import SalesTables


def T(spark, sf_dir) -> SalesTables:
    return SalesTables.of(spark, sf_dir)


@register("dq_unique_key", with_ctes(
    "SELECT 'header' AS TableName, CAST(SalesOrderID AS BIGINT) AS KeyValue, count(*) AS n FROM header_hist GROUP BY "
    "SalesOrderID HAVING count(*) > 1 UNION ALL SELECT 'detail', CAST(SalesOrderDetailID AS BIGINT), count(*) FROM "
    "detail_hist GROUP BY SalesOrderDetailID HAVING count(*) > 1 UNION ALL SELECT 'dim_customer', "
    "CAST(CustomerID AS BIGINT), count(*) FROM dim_customer GROUP BY CustomerID HAVING count(*) > 1",
    "header_hist", "detail_hist", "dim_customer"))
def q_dq_unique_key(spark, sf_dir):
    """Q1: primary keys that are not unique (history headers, details, customer dimension)."""
    t = T(spark, sf_dir)
    dim_c = model.dim_customer(t.customer_src, t.store, t.person)
    return q.tagged_duplicates([("header", t.header_hist, "SalesOrderID"),
                                ("detail", t.detail_hist, "SalesOrderDetailID"),
                                ("dim_customer", dim_c, "CustomerID")])


@register("dq_not_null", with_ctes(
    "SELECT SalesOrderID, ColumnName FROM (SELECT SalesOrderID, unnest(list_filter([CASE WHEN SalesOrderID IS NULL "
    "THEN 'SalesOrderID' END, CASE WHEN OrderDate IS NULL THEN 'OrderDate' END, CASE WHEN DueDate IS NULL THEN 'DueDate' END, CASE WHEN ShipDate IS NULL THEN "
    "'ShipDate' END, CASE WHEN CustomerID IS NULL THEN 'CustomerID' END], lambda x: x IS NOT NULL)) AS ColumnName "
    "FROM orders_temp) s UNION ALL SELECT SalesOrderID, 'SalesOrderID' FROM daily_details_temp WHERE SalesOrderID IS "
    "NULL UNION ALL SELECT SalesOrderID, 'SalesOrderDetailID' FROM daily_details_temp WHERE SalesOrderDetailID IS "
    "NULL", "orders_temp", "daily_details_temp"))
def q_dq_not_null(spark, sf_dir):
    """Q2: staged orders and lines with a NULL id or required column."""
    t = T(spark, sf_dir)
    orders = q.null_columns(t.orders_temp, "SalesOrderID",
                            ["SalesOrderID", "OrderDate", "DueDate", "ShipDate", "CustomerID"])
    return orders.unionByName(q.null_columns(t.daily_details_temp, "SalesOrderID",
                                             ["SalesOrderID", "SalesOrderDetailID"]))


@register("dq_batch_unique", with_ctes(
    "SELECT 'orders_temp' AS TableName, CAST(SalesOrderID AS BIGINT) AS KeyValue, count(*) AS n FROM orders_temp "
    "GROUP BY SalesOrderID HAVING count(*) > 1 UNION ALL SELECT 'daily_details_temp', CAST(SalesOrderDetailID AS "
    "BIGINT), count(*) FROM daily_details_temp GROUP BY SalesOrderDetailID HAVING count(*) > 1",
    "orders_temp", "daily_details_temp"))
def q_dq_batch_unique(spark, sf_dir):
    """Q3: ids repeated inside the staged batch."""
    t = T(spark, sf_dir)
    return q.tagged_duplicates([("orders_temp", t.orders_temp, "SalesOrderID"),
                                ("daily_details_temp", t.daily_details_temp, "SalesOrderDetailID")])


# Batches with faults of every kind that the checks look for, taken from the rows of the tables themselves.
FAULTY_PRODUCT = 1_000_000_000      # added to a product id, so that no product has it
oc.add("orders_faulty",
       "SELECT SalesOrderID, OrderDate FROM orders_temp UNION ALL "
       "SELECT SalesOrderID, OrderDate FROM header_hist WHERE SalesOrderID % 200 = 0")
oc.add("lines_faulty",
       "SELECT SalesOrderID, SalesOrderDetailID, CASE WHEN SalesOrderDetailID % 5 = 0 THEN ProductID + "
       f"{FAULTY_PRODUCT} ELSE ProductID END AS ProductID FROM daily_details_temp UNION ALL "
       "SELECT SalesOrderID, SalesOrderDetailID, ProductID FROM detail_hist WHERE SalesOrderID % 200 = 0")
oc.add("header_faulty",
       "SELECT SalesOrderID, OnlineOrderFlag, CASE WHEN SalesOrderID % 100 = 0 THEN CustomerID % 10 ELSE SalesPersonID END "
       "AS SalesPersonID, CASE WHEN SalesOrderID % 300 = 0 THEN -CustomerID ELSE CustomerID END AS CustomerID FROM header_all")


def orders_faulty(t: SalesTables):
    """The staged orders and, staged once more, every 200th of the history."""
    again = t.header_hist.where(F.col("SalesOrderID") % 200 == 0)
    return t.orders_temp.select("SalesOrderID", "OrderDate").unionByName(again.select("SalesOrderID", "OrderDate"))


def lines_faulty(t: SalesTables):
    """The staged lines, every 5th of a product that there isn't, and the lines of the orders staged once more."""
    product = F.when(F.col("SalesOrderDetailID") % 5 == 0, F.col("ProductID") + FAULTY_PRODUCT).otherwise(F.col("ProductID"))
    cols = ["SalesOrderID", "SalesOrderDetailID", "ProductID"]
    return (t.daily_details_temp.withColumn("ProductID", product).select(*cols)
            .unionByName(t.detail_hist.where(F.col("SalesOrderID") % 200 == 0).select(*cols)))


def header_faulty(t: SalesTables):
    """All orders; every 100th has a salesperson, online or not, every 300th a customer that there isn't."""
    return t.header_all.select(
        "SalesOrderID", "OnlineOrderFlag",
        F.when(F.col("SalesOrderID") % 100 == 0, F.col("CustomerID") % 10).otherwise(F.col("SalesPersonID")).alias("SalesPersonID"),
        F.when(F.col("SalesOrderID") % 300 == 0, -F.col("CustomerID")).otherwise(F.col("CustomerID")).alias("CustomerID"))


@register("dq_no_overlap_history", with_ctes(
    "SELECT 'orders_temp' AS TableName, SalesOrderID AS KeyValue FROM orders_faulty WHERE SalesOrderID IN (SELECT "
    "SalesOrderID FROM header_hist) UNION ALL SELECT 'daily_details_temp', SalesOrderDetailID FROM "
    "lines_faulty WHERE SalesOrderDetailID IN (SELECT SalesOrderDetailID FROM detail_hist)",
    "orders_faulty", "header_hist", "lines_faulty", "detail_hist"))
def q_dq_no_overlap_history(spark, sf_dir):
    """Q4: ids of the faulty batch that already exist in the history."""
    t = T(spark, sf_dir)
    a = q.keys_present(orders_faulty(t), t.header_hist, "SalesOrderID") \
        .select(F.lit("orders_temp").alias("TableName"), F.col("SalesOrderID").alias("KeyValue"))
    b = q.keys_present(lines_faulty(t), t.detail_hist, "SalesOrderDetailID") \
        .select(F.lit("daily_details_temp").alias("TableName"), F.col("SalesOrderDetailID").alias("KeyValue"))
    return a.unionByName(b)


@register("dq_order_date_expected", with_ctes(
    "SELECT * FROM (SELECT min(OrderDate) AS MinDate, max(OrderDate) AS MaxDate, CAST((SELECT max(OrderDate) FROM "
    "header_hist) + 1 AS DATE) AS ExpectedDate FROM orders_temp) s WHERE MinDate <> ExpectedDate OR MaxDate <> "
    "ExpectedDate", "orders_temp", "header_hist"))
def q_dq_order_date_expected(spark, sf_dir):
    """Q5: the batch is not dated the day after the history's last order."""
    t = T(spark, sf_dir)
    return q.dates_expected(t.orders_temp, t.header_hist)


@register("dq_ids_after_max", with_ctes(
    "SELECT * FROM (SELECT min(SalesOrderID) AS MinNewID, (SELECT max(SalesOrderID) FROM header_hist) AS MaxOldID "
    "FROM orders_temp) s WHERE MinNewID <= MaxOldID", "orders_temp", "header_hist"))
def q_dq_ids_after_max(spark, sf_dir):
    """Q6: new order ids must all be above the largest historical id."""
    t = T(spark, sf_dir)
    return q.ids_after_max(t.orders_temp, t.header_hist, "SalesOrderID")


@register("dq_products_allowed", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, ProductID FROM lines_faulty d WHERE NOT EXISTS (SELECT 1 FROM "
    "cost_history c WHERE c.ProductID = d.ProductID)", "lines_faulty", "cost_history"))
def q_dq_products_allowed(spark, sf_dir):
    """Q7: lines of the faulty batch whose product has no cost history."""
    t = T(spark, sf_dir)
    return q.missing_in(lines_faulty(t), t.cost_history, "ProductID", "ProductID") \
        .select("SalesOrderID", "SalesOrderDetailID", "ProductID")


@register("dq_price_positive", with_ctes(
    "SELECT DISTINCT d.ProductID, p.ListPrice FROM lines_faulty d LEFT JOIN (SELECT ProductID, CASE WHEN ProductID % 7 = 0 "
    "THEN -ListPrice ELSE ListPrice END AS ListPrice FROM price_history WHERE EndDate IS NULL) p ON p.ProductID = d.ProductID "
    "WHERE p.ListPrice IS NULL OR p.ListPrice <= 0", "lines_faulty", "price_history"))
def q_dq_price_positive(spark, sf_dir):
    """Q8: products of the faulty batch without a current, positive list price (every 7th product's is negated)."""
    t = T(spark, sf_dir)
    price = F.when(F.col("ProductID") % 7 == 0, -F.col("ListPrice")).otherwise(F.col("ListPrice"))
    return q.price_positive(lines_faulty(t), t.price_history.withColumn("ListPrice", price.cast("decimal(19,4)")))


@register("dq_cost_coverage", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.ProductID, h.OrderDate FROM detail_hist d JOIN header_hist h ON "
    "d.SalesOrderID = h.SalesOrderID WHERE NOT EXISTS (SELECT 1 FROM cost_history c WHERE c.ProductID = d.ProductID "
    "AND h.OrderDate >= c.StartDate AND (c.EndDate IS NULL OR h.OrderDate <= c.EndDate))",
    "detail_hist", "header_hist", "cost_history"))
def q_dq_cost_coverage(spark, sf_dir):
    """Q9: history lines the margin fact drops for lack of a valid cost."""
    t = T(spark, sf_dir)
    lines = fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                                        t.header_hist, ["OrderDate"])
    return q.uncovered_by_intervals(lines, t.cost_history, "ProductID", "OrderDate")


@register("dq_interval_overlap", with_ctes(
    "SELECT * FROM (SELECT ProductID, StartDate, EndDate, max(coalesce(EndDate, DATE '9999-12-31')) OVER (PARTITION "
    "BY ProductID ORDER BY StartDate, EndDate ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS "
    "EarlierEnd FROM cost_history) s WHERE StartDate <= EarlierEnd", "cost_history"))
def q_dq_interval_overlap(spark, sf_dir):
    """Q10: overlapping cost intervals (each would duplicate fact lines)."""
    return q.overlapping_intervals(T(spark, sf_dir).cost_history)


@register("dq_online_no_salesperson", with_ctes(
    "SELECT SalesOrderID, SalesPersonID FROM header_faulty WHERE OnlineOrderFlag AND SalesPersonID IS NOT NULL",
    "header_faulty"))
def q_dq_online_no_salesperson(spark, sf_dir):
    """Q11: online orders must not carry a salesperson."""
    return q.online_with_salesperson(header_faulty(T(spark, sf_dir)))


FK_SQL = [
    ("detail.ProductID", "lines_faulty", "ProductID", "product", "ProductID"),
    ("detail.SalesOrderID", "detail_hist", "SalesOrderID", "header_hist", "SalesOrderID"),
    ("header.CustomerID", "header_faulty", "CustomerID", "customer_src", "CustomerID"),
    ("header.TerritoryID", "header_hist", "TerritoryID", "territory", "TerritoryID"),
    ("header.SalesPersonID", "header_hist", "SalesPersonID", "sales_person", "BusinessEntityID"),
    ("store.SalesPersonID", "store", "SalesPersonID", "sales_person", "BusinessEntityID"),
    ("customer.StoreID", "customer_src", "StoreID", "store", "BusinessEntityID"),
    ("customer.TerritoryID", "customer_src", "TerritoryID", "territory", "TerritoryID"),
    ("product.ProductSubcategoryID", "product", "ProductSubcategoryID", "product_subcategory",
     "ProductSubcategoryID"),
    ("cost_history.ProductID", "cost_history", "ProductID", "product", "ProductID"),
    ("price_history.ProductID", "price_history", "ProductID", "product", "ProductID"),
    ("product_subcategory.ProductCategoryID", "product_subcategory", "ProductCategoryID", "product_category",
     "ProductCategoryID"),
    ("sales_person.TerritoryID", "sales_person", "TerritoryID", "territory", "TerritoryID"),
]


@register("dq_foreign_keys", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS FkName, CAST(c.{ck} AS BIGINT) AS KeyValue, count(*) AS n FROM {ct} c WHERE c.{ck} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pk} = c.{ck}) GROUP BY c.{ck}" for n, ct, ck, pt, pk in FK_SQL)))
def q_dq_foreign_keys(spark, sf_dir):
    """Q12: orphan child keys per foreign key, with how many rows carry each (lines and orders of the faulty batch)."""
    t = T(spark, sf_dir)
    # The history's lines are those whose order is in the history: summed by order first, their orders are looked up once.
    by_order = q.key_counts(t.detail_all, "SalesOrderID").join(t.header_hist.select("SalesOrderID"), "SalesOrderID", "left_semi")
    frames = {"lines_faulty": lines_faulty(t), "header_faulty": header_faulty(t), "detail_hist": t.detail_hist, "header_hist": t.header_hist, "product": t.product,
              "customer_src": t.customer_src, "territory": t.territory, "sales_person": t.sales_person,
              "store": t.store, "product_subcategory": t.product_subcategory, "cost_history": t.cost_history,
              "price_history": t.price_history, "product_category": t.product_category}
    out = None
    for n, ct, ck, pt, pk in FK_SQL:
        counts = by_order if (ct, ck) == ("detail_hist", "SalesOrderID") else q.key_counts(frames[ct], ck)
        o = (q.orphan_keys(counts, frames[pt], ck, pk)
             .select(F.lit(n).alias("FkName"), F.col(ck).cast("bigint").alias("KeyValue"), "n"))
        out = o if out is None else out.unionByName(o)
    return out


NOT_EMPTY = ["header_hist", "detail_hist", "cost_history", "price_history", "orders_temp", "daily_details_temp"]


@register("dq_not_empty", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS TableName, (SELECT count(*) FROM (SELECT 1 FROM {n} LIMIT 1) s) = 0 AS IsEmpty"
    for n in NOT_EMPTY)))
def q_dq_not_empty(spark, sf_dir):
    """Q13: required inputs are not empty."""
    t = T(spark, sf_dir)
    return q.emptiness([(n, getattr(t, n)) for n in NOT_EMPTY])
