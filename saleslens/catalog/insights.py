"""Registered analyses D1, D2, D6-D11."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslens.catalog import ORACLES, register
from saleslens.catalog import oracle_ctes as oc
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.catalog.pipelines import (AS_OF, HISTORY_END, SNAPSHOT_DATE, _d, _goal_sql, loaded_fact,  # noqa: F401
                                         sales_fact, xpct_sql)
from saleslens.plans import insights as ins
from saleslens.plans import model
from saleslens.sources.fixtures import SalesTables

DAY_BY_DAY_START = SNAPSHOT_DATE.isoformat()


def T(spark, sf_dir) -> SalesTables:
    return SalesTables.of(spark, sf_dir)


def _dim_p(t: SalesTables):
    return model.dim_product(t.product, t.product_subcategory, t.product_category)


@register("doc_revenue_margin", with_ctes(
    "SELECT CAST(year(f.m) AS INTEGER) AS Year, CAST(quarter(f.m) AS INTEGER) AS Quarter, CAST(month(f.m) AS INTEGER) "
    "AS Month, t.Name AS Country, p.Category, CAST(sum(f.LineTotal) AS DECIMAL(38,4)) AS Revenue, "
    "CAST(sum(f.ProductMargin) AS DECIMAL(38,4)) AS Margin, CAST(CAST(sum(f.ProductMargin) AS DECIMAL(38,4)) AS "
    "DOUBLE) / NULLIF(CAST(CAST(sum(f.LineTotal) AS DECIMAL(38,4)) AS DOUBLE), 0.0) AS MarginPct FROM "
    "(SELECT *, date_trunc('month', OrderDate) AS m FROM fact) f JOIN dim_product p ON f.ProductID = p.ProductID "
    "JOIN territory t ON f.TerritoryID = t.TerritoryID GROUP BY 1, 2, 3, 4, 5", "fact", "dim_product", "territory"))
def q_doc_revenue_margin(spark, sf_dir):
    """Revenue, margin, margin % by year/quarter/month x country x category."""
    t = T(spark, sf_dir)
    return ins.revenue_margin(sales_fact(t), _dim_p(t), t.territory)


@register("doc_hierarchy_rollup", with_ctes(
    "SELECT p.Category, p.Subcategory, p.Product, CAST(GROUPING(p.Category, p.Subcategory, p.Product) AS INTEGER) AS "
    "Level, CAST(sum(f.LineTotal) AS DECIMAL(38,4)) AS Revenue, CAST(sum(f.ProductMargin) AS DECIMAL(38,4)) AS "
    "Margin FROM fact f JOIN dim_product p ON f.ProductID = p.ProductID GROUP BY ROLLUP (p.Category, p.Subcategory, "
    "p.Product)", "fact", "dim_product"))
def q_doc_hierarchy_rollup(spark, sf_dir):
    """Drill-down subtotals category -> subcategory -> product."""
    t = T(spark, sf_dir)
    r = ins.hierarchy_rollup(sales_fact(t), _dim_p(t))
    return r.withColumn("Level", F.col("Level").cast("int"))


oc.add("rfm_base",
       f"SELECT h.CustomerID, CAST(datediff('day', max(h.OrderDate), {_d(AS_OF)}) AS INTEGER) AS RecencyDays, "
       "count(*) AS Frequency, CAST(coalesce(sum(v.v), 0) AS DECIMAL(38,4)) AS Value FROM header_hist h LEFT JOIN "
       "(SELECT SalesOrderID, sum(LineTotal) AS v FROM detail_hist GROUP BY SalesOrderID) v ON v.SalesOrderID = "
       "h.SalesOrderID GROUP BY h.CustomerID")


@register("doc_customer_segments", with_ctes(
    "SELECT r.CustomerID, CASE WHEN c.StoreID IS NOT NULL THEN 'Store' ELSE 'Individual' END AS CustomerType, "
    "RecencyDays, Frequency, Value, CAST(ntile(5) OVER (ORDER BY RecencyDays DESC, r.CustomerID) AS INTEGER) AS R, "
    "CAST(ntile(5) OVER (ORDER BY Frequency, r.CustomerID) AS INTEGER) AS F, CAST(ntile(5) OVER (ORDER BY Value, "
    "r.CustomerID) AS INTEGER) AS M FROM rfm_base r JOIN customer_src c ON c.CustomerID = r.CustomerID",
    "rfm_base", "customer_src"))
def q_doc_customer_segments(spark, sf_dir):
    """Recency / frequency / value quintiles with customer type."""
    t = T(spark, sf_dir)
    return ins.customer_rfm(t.header_hist, t.detail_all, t.customer_src, AS_OF)


oc.add("per_product_rev", "SELECT ProductID, CAST(sum(LineTotal) AS DECIMAL(38,4)) AS Revenue FROM fact "
                          "GROUP BY ProductID")


@register("doc_product_segments", with_ctes(
    "SELECT ProductID, Revenue, CAST(CumRevenue AS DECIMAL(38,4)) AS CumRevenue, CASE WHEN CumRevenue * 100 <= "
    "(SELECT sum(Revenue) FROM per_product_rev) * 80 THEN 'A' WHEN CumRevenue * 100 <= (SELECT sum(Revenue) FROM "
    "per_product_rev) * 95 THEN 'B' ELSE 'C' END AS Class FROM (SELECT ProductID, Revenue, sum(Revenue) OVER (ORDER "
    "BY Revenue DESC, ProductID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CumRevenue FROM "
    "per_product_rev) r", "per_product_rev"))
def q_doc_product_segments(spark, sf_dir):
    """ABC classes by cumulative revenue share (80 / 95 %)."""
    return ins.product_abc(sales_fact(T(spark, sf_dir)))


@register("doc_product_classes", f"SELECT ProductID, Revenue, Class FROM ({ORACLES['doc_product_segments']}) abc")
def q_doc_product_classes(spark, sf_dir):
    """The ABC classes without the cumulative column, from the limits of the shares."""
    return ins.product_classes(sales_fact(T(spark, sf_dir)))


@register("doc_cohort_retention", with_ctes(
    "WITH act AS (SELECT DISTINCT CustomerID, CAST(date_trunc('month', OrderDate) AS DATE) AS m FROM header_hist), "
    "first AS (SELECT CustomerID, min(m) AS Cohort FROM act GROUP BY CustomerID), j AS (SELECT a.CustomerID, "
    "f.Cohort, CAST((year(a.m) - year(f.Cohort)) * 12 + month(a.m) - month(f.Cohort) AS INTEGER) AS MonthOffset "
    "FROM act a JOIN first f ON a.CustomerID = f.CustomerID), g AS (SELECT Cohort, MonthOffset, count(*) AS "
    "ActiveCustomers FROM j GROUP BY Cohort, MonthOffset), size AS (SELECT Cohort, count(*) AS CohortSize FROM first "
    "GROUP BY Cohort) SELECT g.Cohort AS CohortMonth, g.MonthOffset, g.ActiveCustomers, size.CohortSize, "
    "CAST(g.ActiveCustomers AS DOUBLE) / size.CohortSize AS RetentionRate FROM g JOIN size ON g.Cohort = size.Cohort",
    "header_hist").replace("\nWITH act AS", ",\nact AS"))
def q_doc_cohort_retention(spark, sf_dir):
    """First-order-month cohorts and their retention by month offset."""
    return ins.cohort_retention(T(spark, sf_dir).header_hist)


@register("doc_repurchase_timing", with_ctes(
    "SELECT Segment, count(*) AS Gaps, round(avg(Gap), 6) AS MeanGap, "
    f"CAST({xpct_sql('list_sort(list(Gap))', 'count(*)', '0.5')} AS DOUBLE) AS MedianGap, "
    f"CAST({xpct_sql('list_sort(list(Gap))', 'count(*)', '0.9')} AS DOUBLE) AS P90Gap FROM (SELECT CASE WHEN "
    "c.StoreID IS NOT NULL THEN 'Store' ELSE 'Individual' END AS Segment, g.Gap FROM (SELECT CustomerID, "
    "datediff('day', lag(OrderDate) OVER (PARTITION BY CustomerID ORDER BY OrderDate), OrderDate) AS Gap FROM "
    "(SELECT DISTINCT CustomerID, OrderDate FROM header_hist) d) g JOIN customer_src c ON c.CustomerID = "
    "g.CustomerID WHERE g.Gap IS NOT NULL) s GROUP BY Segment", "header_hist", "customer_src"))
def q_doc_repurchase_timing(spark, sf_dir):
    """Days between consecutive order dates: mean, median, P90 per customer type."""
    t = T(spark, sf_dir)
    return ins.repurchase_timing(t.header_hist, t.customer_src)


oc.add("order_cat",
       "SELECT SalesOrderID, CustomerID, OrderDate, Category FROM (SELECT *, row_number() OVER (PARTITION BY "
       "SalesOrderID ORDER BY rev DESC, Category) AS rn FROM (SELECT f.SalesOrderID, f.CustomerID, f.OrderDate, "
       "coalesce(p.Category, 'NONE') AS Category, sum(f.LineTotal) AS rev FROM fact f JOIN dim_product p ON "
       "f.ProductID = p.ProductID GROUP BY 1, 2, 3, 4) a) b WHERE rn = 1")
oc.add("order_nth",
       "SELECT CustomerID, Category, row_number() OVER (PARTITION BY CustomerID ORDER BY OrderDate, SalesOrderID) "
       "AS Nth FROM order_cat")


@register("doc_purchase_sequence", with_ctes(
    "SELECT Category, NextCategory, Transitions, CAST(Transitions AS DOUBLE) / sum(Transitions) OVER (PARTITION BY "
    "Category) AS Share FROM (SELECT a.Category, b.Category AS NextCategory, count(*) AS Transitions FROM order_nth "
    "a JOIN order_nth b ON a.CustomerID = b.CustomerID AND b.Nth = a.Nth + 1 GROUP BY 1, 2) s", "order_nth"))
def q_doc_purchase_sequence(spark, sf_dir):
    """Category of order n -> category of order n+1, counts and shares."""
    t = T(spark, sf_dir)
    return ins.purchase_sequence(sales_fact(t), _dim_p(t))


oc.add("dbd_prev",
       f"SELECT CAST(sum(LineTotal) AS DOUBLE) AS p FROM fact_loaded WHERE OrderDate >= make_date(year({_d(AS_OF)}) - 1, "
       f"1, 1) AND OrderDate < make_date(year({_d(AS_OF)}), 1, 1)")
oc.add("dbd_base",
       "SELECT d.Date, CAST(coalesce(r.rev, 0) AS DECIMAL(38,4)) AS Revenue FROM (SELECT CAST(unnest(generate_series("
       f"DATE '{DAY_BY_DAY_START}', {_d(AS_OF)}, INTERVAL 1 DAY)) AS DATE) AS Date) d LEFT JOIN (SELECT "
       f"OrderDate AS Date, sum(LineTotal) AS rev FROM fact_loaded WHERE OrderDate >= DATE '{DAY_BY_DAY_START}' AND "
       f"OrderDate <= {_d(AS_OF)} GROUP BY OrderDate) r ON r.Date = d.Date")


@register("doc_day_by_day", with_ctes(
    "SELECT Date, Revenue, CumRevenue, DayIndex, CumGoal, CAST(CumRevenue AS DOUBLE) - CumGoal AS Gap FROM (SELECT "
    "Date, Revenue, CAST(sum(Revenue) OVER (ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "
    "DECIMAL(38,4)) AS CumRevenue, row_number() OVER (ORDER BY Date) AS DayIndex, (SELECT p FROM dbd_prev) / "
    f"NULLIF(datediff('day', make_date(year({_d(AS_OF)}) - 1, 1, 1), make_date(year({_d(AS_OF)}), 1, 1)), "
    "0) * 1.3012 * row_number() OVER (ORDER BY Date) AS CumGoal FROM dbd_base) s", "dbd_prev", "dbd_base"))
def q_doc_day_by_day(spark, sf_dir):
    """Calendar-filled daily revenue since the snapshot, cumulative revenue vs cumulative daily goal."""
    f = loaded_fact(spark, T(spark, sf_dir))
    out = ins.day_by_day(f, DAY_BY_DAY_START, AS_OF, AS_OF)
    return out.withColumn("DayIndex", F.col("DayIndex").cast("bigint"))
