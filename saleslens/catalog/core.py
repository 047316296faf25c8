"""Registered building-block operators: sources, projections, filters, joins,
aggregations, sort/set operations and scalar functions (SURVEY §2.1-2.6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from saleslens.catalog import register
from saleslens.catalog import oracle_ctes as oc
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.catalog.pipelines import (AS_OF, SHIFT_TO, _d, ceil1_sql, export_at_snapshot, floor1_sql,
                                         current_pairs, loaded_fact, offer_lookup_sql, profile_lines, sales_fact,
                                         special_offers, xpct_sql)
from saleslens.functions import dates as fd
from saleslens.functions import money as fm
from saleslens.functions import text as ft
from saleslens.operators import joins as oj
from saleslens.operators import sets as os_
from saleslens.plans import fact as fact_plan
from saleslens.plans import model, profile
from saleslens.session import fresh_dir
from saleslens.sources import files
from saleslens.sources.fixtures import SalesTables

NEW_ID = 1000000000   # ids from here on: listed products and registered customers without any order


def T(spark, sf_dir) -> SalesTables:
    return SalesTables.of(spark, sf_dir)


# ---------------------------------------------------------------------------
# §2.1 sources and sinks
# ---------------------------------------------------------------------------
@register("src_table_scan", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, ProductID, OrderQty FROM detail_all WHERE OrderQty >= 25",
    "detail_all"))
def q_src_table_scan(spark, sf_dir):
    """Chosen columns of a table with a filter pushed to the Parquet scan."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    li = files.scan(spark, path, where=F.col("l_quantity") >= 25)
    return li.select(F.col("l_orderkey").alias("SalesOrderID"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("SalesOrderDetailID"),
                     F.col("l_partkey").alias("ProductID"), F.col("l_quantity").cast("smallint").alias("OrderQty"))


@register("sink_csv", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount, LineTotal, "
    "SpecialOfferID FROM detail_hist", "detail_hist"))
def q_sink_csv(spark, sf_dir):
    """The detail history backed up as CSV with a header, read back typed."""
    t = T(spark, sf_dir)
    d = t.detail_hist
    path = files.write_csv(d, fresh_dir(spark, "backup-csv"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@register("register_view", with_ctes(
    "SELECT TerritoryID, count(*) AS Lines, CAST(sum(LineTotal) AS DECIMAL(38,4)) AS Revenue, "
    "CAST(sum(ProductMargin) AS DECIMAL(38,4)) AS Margin FROM fact GROUP BY TerritoryID", "fact"))
def q_register_view(spark, sf_dir):
    """The fact registered as a view and queried with SQL (view on view)."""
    files.register_view(sales_fact(T(spark, sf_dir)), "sales_fact_view")
    return spark.sql("SELECT TerritoryID, count(*) AS Lines, CAST(sum(LineTotal) AS DECIMAL(38,4)) AS Revenue, "
                     "CAST(sum(ProductMargin) AS DECIMAL(38,4)) AS Margin FROM sales_fact_view GROUP BY TerritoryID")


@register("normalize_columns", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount FROM detail_base",
    "detail_base"))
def q_normalize_columns(spark, sf_dir):
    """Drifted column names (casing, DiscountPct) resolved to the canonical ones."""
    d = T(spark, sf_dir).detail_base
    drifted = d.toDF("salesorderid", "SalesorderdetailID", "ORDERQTY", "ProductId", "unitprice", "DiscountPct")
    return files.normalize_columns(drifted, ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID",
                                             "UnitPrice", "UnitPriceDiscount"],
                                   {"DiscountPct": "UnitPriceDiscount"})


# ---------------------------------------------------------------------------
# §2.2 projections and filters
# ---------------------------------------------------------------------------
@register("project_rename", with_ctes(
    "SELECT SalesOrderDetailID, SalesOrderID, OrderQty, ProductID, UnitPrice, LineTotal, UnitPriceDiscount AS "
    "DiscountPct, SpecialOfferID FROM detail_all", "detail_all"))
def q_project_rename(spark, sf_dir):
    """Reorder and rename columns."""
    d = T(spark, sf_dir).detail_all
    return d.select("SalesOrderDetailID", "SalesOrderID", "OrderQty", "ProductID", "UnitPrice", "LineTotal",
                    F.col("UnitPriceDiscount").alias("DiscountPct"), "SpecialOfferID")


@register("project_star_plus", with_ctes(
    "SELECT d.*, h.OrderDate, h.CustomerID, CAST(d.UnitPrice * d.OrderQty AS DECIMAL(19,4)) AS GrossValue "
    "FROM detail_hist d JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID", "detail_hist", "header_hist"))
def q_project_star_plus(spark, sf_dir):
    """All line columns plus picked header columns plus a computed one."""
    t = T(spark, sf_dir)
    j = fact_plan.lines_with_header(t.detail_all, t.header_hist, ["OrderDate", "CustomerID"])
    return j.select(*t.detail_hist.columns, "OrderDate", "CustomerID",
                    fm.gross_line_value().alias("GrossValue"))


@register("project_literal", with_ctes(
    f"SELECT SalesOrderID, {_d(AS_OF)} AS LoadDate, 'project' AS SourceTag FROM header_all", "header_all"))
def q_project_literal(spark, sf_dir):
    """Constant tag columns."""
    h = T(spark, sf_dir).header_all
    return h.select("SalesOrderID", F.lit(AS_OF).alias("LoadDate"), F.lit("project").alias("SourceTag"))


@register("filter_threshold", with_ctes(
    "SELECT o.SpecialOfferID, o.Description, count(d.SalesOrderDetailID) AS Lines FROM special_offer o "
    "LEFT JOIN detail_hist d ON d.SpecialOfferID = o.SpecialOfferID GROUP BY o.SpecialOfferID, o.Description",
    "special_offer", "detail_hist"))
def q_filter_threshold(spark, sf_dir):
    """Offers with id below 7, with how many history lines use each."""
    t = T(spark, sf_dir)
    per_offer = t.detail_hist.groupBy("SpecialOfferID").agg(F.count(F.lit(1)).alias("Lines"))
    return (special_offers(t).join(per_offer, "SpecialOfferID", "left")
            .select("SpecialOfferID", "Description", F.coalesce("Lines", F.lit(0)).alias("Lines")))


@register("filter_not_null", with_ctes(
    "SELECT BusinessEntityID, FirstName, LastName FROM person WHERE FirstName IS NOT NULL AND LastName IS NOT NULL",
    "person"))
def q_filter_not_null(spark, sf_dir):
    """P5: IS NOT NULL conjunction."""
    p = T(spark, sf_dir).person
    return p.where(F.col("FirstName").isNotNull() & F.col("LastName").isNotNull())


@register("filter_current_version", with_ctes(
    "SELECT ProductID, ListPrice FROM price_history WHERE EndDate IS NULL", "price_history"))
def q_filter_current_version(spark, sf_dir):
    """The current (open) version of each list price."""
    return T(spark, sf_dir).price_history.where(F.col("EndDate").isNull()).select("ProductID", "ListPrice")


@register("filter_date_lower_bound", with_ctes(
    "SELECT SalesOrderID, OrderDate, CustomerID FROM header_hist WHERE OrderDate >= DATE '2000-01-01'",
    "header_hist"))
def q_filter_date_lower_bound(spark, sf_dir):
    """Orders from a start date on (pushed to the orders scan)."""
    h = T(spark, sf_dir).header_hist
    return h.where(F.col("OrderDate") >= F.lit(profile.PROFILE_START)).select("SalesOrderID", "OrderDate",
                                                                                "CustomerID")


@register("filter_pending_today", with_ctes(
    f"SELECT * FROM orders_temp WHERE NOT processed AND CAST(modified_date AS DATE) = {_d(AS_OF)}", "orders_temp"))
def q_filter_pending_today(spark, sf_dir):
    """Unprocessed staged orders of today."""
    from saleslens.plans.daily import pending_today
    return pending_today(T(spark, sf_dir).orders_temp, AS_OF)


@register("filter_positive", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, UnitPrice, UnitPriceDiscount FROM detail_all "
    "WHERE UnitPrice > 0 AND UnitPriceDiscount > 0", "detail_all"))
def q_filter_positive(spark, sf_dir):
    """Positive price and positive discount."""
    d = T(spark, sf_dir).detail_all
    return d.where((F.col("UnitPrice") > 0) & (F.col("UnitPriceDiscount") > 0)) \
            .select("SalesOrderID", "SalesOrderDetailID", "UnitPrice", "UnitPriceDiscount")


# ---------------------------------------------------------------------------
# §2.3 joins
# ---------------------------------------------------------------------------
@register("join_detail_header", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.ProductID, d.LineTotal, h.OrderDate, h.CustomerID, "
    "h.TerritoryID FROM detail_hist d JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID",
    "detail_hist", "header_hist"))
def q_join_detail_header(spark, sf_dir):
    """Inner equi-join of lines and headers."""
    t = T(spark, sf_dir)
    return fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID",
                                                            "LineTotal"),
                                       t.header_hist, ["OrderDate", "CustomerID", "TerritoryID"])


@register("join_scd2_cost", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.ProductID, h.OrderDate, c.StartDate AS CostStart, "
    "c.StandardCost FROM detail_hist d JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID JOIN cost_history c "
    "ON d.ProductID = c.ProductID AND h.OrderDate >= c.StartDate AND (c.EndDate IS NULL OR h.OrderDate <= "
    "c.EndDate)", "detail_hist", "header_hist", "cost_history"))
def q_join_scd2_cost(spark, sf_dir):
    """The cost valid on each line's order date (closed interval, NULL end = open)."""
    t = T(spark, sf_dir)
    lines = fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                                        t.header_hist, ["OrderDate"])
    c = t.cost_history.withColumn("CostStart", F.col("StartDate"))
    return oj.interval_join(lines, oj.small_side(c.select("ProductID", "StartDate", "EndDate", "CostStart", "StandardCost")), "ProductID",
                            "OrderDate", right_cols=["CostStart", "StandardCost"])


from saleslens.catalog import ORACLES as _ORACLES  # noqa: E402


@register("join_scd2_cost_by_month", _ORACLES["join_scd2_cost"])
def q_join_scd2_cost_by_month(spark, sf_dir):
    """J2 with the lines of hot products dealt by month: the rows of join_scd2_cost."""
    t = T(spark, sf_dir)
    lines = fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                                        t.header_hist, ["OrderDate"])
    c = t.cost_history.withColumn("CostStart", F.col("StartDate"))
    return fact_plan.costed_lines(lines, t.detail_all, t.header_hist, c, ["CostStart", "StandardCost"], by_month=True)


@register("fact_sales_margin_by_month", _ORACLES["fact_sales_margin"])
def q_fact_sales_margin_by_month(spark, sf_dir):
    """W10 with the lines of hot products dealt by month: the rows of fact_sales_margin."""
    t = T(spark, sf_dir)
    return fact_plan.fact_sales_margin(t.detail_all, t.header_hist, t.cost_history, by_month=True)


@register("join_scd2_list_price", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.ProductID, h.OrderDate, p.ListPrice FROM detail_hist d "
    "JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID JOIN price_history p ON d.ProductID = p.ProductID AND "
    "h.OrderDate >= p.StartDate AND (p.EndDate IS NULL OR h.OrderDate <= p.EndDate)",
    "detail_hist", "header_hist", "price_history"))
def q_join_scd2_list_price(spark, sf_dir):
    """The list price valid on each line's order date."""
    t = T(spark, sf_dir)
    lines = fact_plan.lines_with_header(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                                        t.header_hist, ["OrderDate"])
    return oj.interval_join(lines, oj.small_side(t.price_history), "ProductID", "OrderDate", right_cols=["ListPrice"])


@register("join_snowflake_left", with_ctes(
    "SELECT p.ProductID, p.ProductSubcategoryID, sc.ProductCategoryID, sc.Name AS Subcategory, c.Name AS Category "
    "FROM product p LEFT JOIN product_subcategory sc ON p.ProductSubcategoryID = sc.ProductSubcategoryID LEFT JOIN "
    "product_category c ON sc.ProductCategoryID = c.ProductCategoryID",
    "product", "product_subcategory", "product_category"))
def q_join_snowflake_left(spark, sf_dir):
    """Product -> subcategory -> category, left outer both steps (ids kept)."""
    t = T(spark, sf_dir)
    sc = t.product_subcategory.select("ProductSubcategoryID", "ProductCategoryID",
                                      F.col("Name").alias("Subcategory"))
    cat = t.product_category.select("ProductCategoryID", F.col("Name").alias("Category"))
    return (t.product.select("ProductID", "ProductSubcategoryID")
            .join(sc, "ProductSubcategoryID", "left").join(F.broadcast(cat), "ProductCategoryID", "left")
            .select("ProductID", "ProductSubcategoryID", "ProductCategoryID", "Subcategory", "Category"))


@register("join_dims_inner", with_ctes(
    "SELECT f.SalesOrderID, f.SalesOrderDetailID, t.Name AS Country, p.Subcategory, f.LineTotal FROM fact f "
    "JOIN dim_product p ON f.ProductID = p.ProductID JOIN territory t ON f.TerritoryID = t.TerritoryID",
    "fact", "dim_product", "territory"))
def q_join_dims_inner(spark, sf_dir):
    """Fact lines with product and territory dimensions."""
    t = T(spark, sf_dir)
    dim_p = model.dim_product(t.product, t.product_subcategory, t.product_category).select("ProductID",
                                                                                            "Subcategory")
    terr = t.territory.select("TerritoryID", F.col("Name").alias("Country"))
    return (sales_fact(t).join(oj.small_side(dim_p), "ProductID").join(oj.small_side(terr), "TerritoryID")
            .select("SalesOrderID", "SalesOrderDetailID", "Country", "Subcategory", "LineTotal"))


@register("join_snapshot_left", with_ctes(
    "SELECT s.Country, s.Subcategory, s.PriorityType, c.CurrentRevenue, c.PreviousYearRevenue FROM snapshot s "
    "LEFT JOIN rev_pairs_asof c ON c.Country = s.Country AND c.Subcategory = s.Subcategory",
    "snapshot", "rev_pairs_asof"))
def q_join_snapshot_left(spark, sf_dir):
    """Every snapshot pair kept, current figures where they exist."""
    from saleslens.catalog.pipelines import snapshot_and_current
    s, current = snapshot_and_current(spark, T(spark, sf_dir))
    return s.select("Country", "Subcategory", "PriorityType").join(current, ["Country", "Subcategory"], "left")


@register("semi_exists", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.ProductID FROM detail_hist d WHERE EXISTS (SELECT 1 FROM "
    "cost_history c WHERE c.ProductID = d.ProductID)", "detail_hist", "cost_history"))
def q_semi_exists(spark, sf_dir):
    """Lines whose product has a cost (EXISTS -> left semi join)."""
    t = T(spark, sf_dir)
    return oj.semi(t.detail_hist.select("SalesOrderID", "SalesOrderDetailID", "ProductID"),
                   t.cost_history.select("ProductID"), "ProductID")


@register("semi_distinct_subquery", with_ctes(
    "SELECT p.ProductID FROM product p JOIN (SELECT DISTINCT ProductID FROM cost_history) c "
    "ON c.ProductID = p.ProductID", "product", "cost_history"))
def q_semi_distinct_subquery(spark, sf_dir):
    """Inner join to a DISTINCT subquery, planned as a semi join."""
    t = T(spark, sf_dir)
    return oj.semi(t.product.select("ProductID"), t.cost_history.select("ProductID"), "ProductID")


oc.add("listed_products", "SELECT ProductID FROM cost_history UNION ALL SELECT p_partkey + 1000000000 FROM part "
                          "WHERE p_partkey % 50 = 0")
oc.add("registered_customers", "SELECT CustomerID FROM customer_src UNION ALL SELECT c_custkey + 1000000000 FROM "
                               "customer WHERE c_custkey % 50 = 0")


def _listed_products(t: SalesTables):
    new = t.raw("part").where(F.col("p_partkey") % 50 == 0).select((F.col("p_partkey") + NEW_ID).alias("ProductID"))
    return t.cost_history.select("ProductID").unionByName(new)


def _registered_customers(t: SalesTables):
    k = F.col("c_custkey")
    new = t.raw("customer").where(k % 50 == 0).select((k + NEW_ID).alias("CustomerID"))
    return t.customer_src.select("CustomerID").unionByName(new)


def _orders(t: SalesTables, since=None):
    """All history headers, or those since a day."""
    return t.header_hist if since is None else t.header_hist.where(F.col("OrderDate") >= F.lit(since))


def _sold(t: SalesTables, since=None):
    return (t.detail_all.select("SalesOrderID", "ProductID")
            .join(_orders(t, since).select("SalesOrderID"), "SalesOrderID").select("ProductID"))


@register("anti_unsold_products", with_ctes(
    "SELECT DISTINCT c.ProductID FROM listed_products c WHERE NOT EXISTS (SELECT 1 FROM detail_hist r WHERE "
    "r.ProductID = c.ProductID)", "listed_products", "detail_hist"))
def q_anti_unsold_products(spark, sf_dir):
    """Listed products never sold in the history."""
    t = T(spark, sf_dir)
    return oj.semi(_listed_products(t).distinct(), _sold(t), "ProductID", anti=True)


@register("anti_new_customers", with_ctes(
    "SELECT c.CustomerID FROM registered_customers c WHERE NOT EXISTS (SELECT 1 FROM header_hist h WHERE "
    "h.CustomerID = c.CustomerID)", "registered_customers", "header_hist"))
def q_anti_new_customers(spark, sf_dir):
    """Registered customers who never ordered in the history."""
    t = T(spark, sf_dir)
    return oj.semi(_registered_customers(t), _orders(t).select("CustomerID"), "CustomerID", anti=True)


oc.add("offer_lookup_hist", offer_lookup_sql("detail_hist"))


@register("range_join_offer_tier", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, k.SpecialOfferID, o.UnitPriceDiscount FROM "
    "detail_hist d LEFT JOIN offer_lookup_hist k ON d.OrderQty = k.OrderQty LEFT JOIN special_offer o ON "
    "o.SpecialOfferID = k.SpecialOfferID", "detail_hist", "offer_lookup_hist", "special_offer"))
def q_range_join_offer_tier(spark, sf_dir):
    """Each history line's offer by quantity range, best by preference, with fallback."""
    t = T(spark, sf_dir)
    return profile.assign_offers(t.detail_hist.select("SalesOrderID", "SalesOrderDetailID", "OrderQty"),
                                 special_offers(t))


@register("range_join_tier_profile", with_ctes(
    "SELECT o.SpecialOfferID, greatest(1, o.MinQty) AS TierMin, CASE WHEN o.MaxQty IS NOT NULL THEN "
    "greatest(greatest(1, o.MinQty), o.MaxQty) END AS TierMax, count(l.OrderQty) AS HistoryLines, "
    "count(l.OrderQty) > 0 AS HasHistory FROM special_offer o LEFT JOIN profile_lines l ON l.OrderQty >= "
    "greatest(1, o.MinQty) AND (o.MaxQty IS NULL OR l.OrderQty <= greatest(greatest(1, o.MinQty), o.MaxQty)) "
    "WHERE o.UnitPriceDiscount > 0 GROUP BY 1, 2, 3", "special_offer", "profile_lines"))
def q_range_join_tier_profile(spark, sf_dir):
    """History lines per discounted tier; empty tiers kept."""
    t = T(spark, sf_dir)
    return profile.tier_profile(profile_lines(t), special_offers(t))


@register("update_from_join", with_ctes(
    "SELECT h.SalesOrderID, h.OrderDate, coalesce(s.SubTotal, h.SubTotal) AS SubTotal FROM header_hist h LEFT JOIN "
    "(SELECT SalesOrderID, CAST(sum(LineTotal) AS DECIMAL(19,4)) AS SubTotal FROM detail_hist GROUP BY "
    "SalesOrderID) s ON s.SalesOrderID = h.SalesOrderID", "header_hist", "detail_hist"))
def q_update_from_join(spark, sf_dir):
    """UPDATE ... FROM: order subtotals replaced by the sum of their lines where lines exist."""
    t = T(spark, sf_dir)
    sums = t.detail_hist.groupBy("SalesOrderID").agg(F.sum("LineTotal").cast(fm.MONEY).alias("NewSubTotal"))
    return (t.header_hist.join(sums, "SalesOrderID", "left")
            .select("SalesOrderID", "OrderDate", F.coalesce("NewSubTotal", "SubTotal").alias("SubTotal")))


@register("delete_by_join", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, OrderQty, ProductID FROM detail_all d WHERE NOT EXISTS (SELECT 1 "
    "FROM orders_temp o WHERE o.SalesOrderID = d.SalesOrderID)", "detail_all", "orders_temp"))
def q_delete_by_join(spark, sf_dir):
    """DELETE ... JOIN key list as an anti join (staged orders removed from the lines)."""
    t = T(spark, sf_dir)
    return oj.semi(t.detail_all.select("SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID"),
                   t.orders_temp.select("SalesOrderID"), "SalesOrderID", anti=True)


# ---------------------------------------------------------------------------
# §2.4 aggregations
# ---------------------------------------------------------------------------
@register("agg_max_anchor", with_ctes(
    "SELECT SalesOrderID, OrderDate, (SELECT max(OrderDate) FROM header_all) AS AnchorDate, CAST(datediff('day', "
    "OrderDate, (SELECT max(OrderDate) FROM header_all)) AS INTEGER) AS DaysBeforeAnchor FROM header_all", "header_all"))
def q_agg_max_anchor(spark, sf_dir):
    """The scalar MAX(OrderDate) fed back into every row (scalar subquery, no join)."""
    h = T(spark, sf_dir).header_all
    anchor = model.max_order_date(h)
    return h.select("SalesOrderID", "OrderDate", anchor.alias("AnchorDate"),
                    F.datediff(anchor, F.col("OrderDate")).alias("DaysBeforeAnchor"))


@register("agg_latest_per_key", with_ctes(
    "SELECT c.ProductID, c.StartDate, c.StandardCost FROM cost_history_raw c JOIN (SELECT ProductID, "
    "max(StartDate) AS m FROM cost_history_raw GROUP BY ProductID) l ON c.ProductID = l.ProductID AND "
    "c.StartDate = l.m", "cost_history_raw"))
def q_agg_latest_per_key(spark, sf_dir):
    """MAX(StartDate) per product joined back: the latest cost row."""
    c = T(spark, sf_dir).cost_history_raw
    latest = c.groupBy("ProductID").agg(F.max("StartDate").alias("StartDate"))
    return c.join(latest, ["ProductID", "StartDate"]).select("ProductID", "StartDate", "StandardCost")


@register("agg_conditional_sum", with_ctes(
    "SELECT TerritoryID, CAST(SUM(CASE WHEN OrderDate >= DATE '2001-01-01' AND OrderDate < DATE '2001-08-02' "
    "THEN LineTotal ELSE 0 END) AS DECIMAL(38,4)) AS CurrentRevenue, CAST(SUM(CASE WHEN OrderDate >= "
    "DATE '2000-01-01' AND OrderDate < DATE '2001-01-01' THEN LineTotal ELSE 0 END) AS DECIMAL(38,4)) AS "
    "PreviousYearRevenue FROM fact GROUP BY TerritoryID", "fact"))
def q_agg_conditional_sum(spark, sf_dir):
    """Year-to-date and prior-year revenue per territory with CASE-guarded sums."""
    f = sales_fact(T(spark, sf_dir))
    y0, y1, nxt = fd.year_start(AS_OF), fd.year_start(AS_OF, 1), fd.day_after(AS_OF)
    od, lt = F.col("OrderDate"), F.col("LineTotal")
    z = F.lit(0).cast(fm.MONEY)
    return f.groupBy("TerritoryID").agg(
        F.sum(F.when((od >= y0) & (od < nxt), lt).otherwise(z)).cast(fm.SUM_MONEY).alias("CurrentRevenue"),
        F.sum(F.when((od >= y1) & (od < y0), lt).otherwise(z)).cast(fm.SUM_MONEY).alias("PreviousYearRevenue"))


@register("agg_country_subcategory", with_ctes("SELECT * FROM rev_pairs_asof", "rev_pairs_asof"))
def q_agg_country_subcategory(spark, sf_dir):
    """The two-key revenue aggregate over fact x product x territory, after the daily load."""
    t = T(spark, sf_dir)
    return current_pairs(t, AS_OF, loaded_fact(spark, t))


@register("agg_having_duplicates", with_ctes(
    "SELECT SalesOrderDetailID, count(*) AS n FROM detail_all GROUP BY SalesOrderDetailID HAVING count(*) > 1",
    "detail_all"))
def q_agg_having_duplicates(spark, sf_dir):
    """Keys that occur more than once, and how often."""
    from saleslens.operators.quality import duplicate_keys
    return duplicate_keys(T(spark, sf_dir).detail_all, ["SalesOrderDetailID"])


@register("agg_distinct", with_ctes("SELECT DISTINCT ProductID FROM detail_hist", "detail_hist"))
def q_agg_distinct(spark, sf_dir):
    """Distinct sold product ids."""
    return T(spark, sf_dir).detail_hist.select("ProductID").distinct()


@register("agg_daily_totals", with_ctes(
    "SELECT OrderDate, CAST(sum(OrderQty) AS BIGINT) AS DailyQty, count(DISTINCT SalesOrderID) AS DailyOrders "
    "FROM profile_lines "
    "GROUP BY OrderDate", "profile_lines"))
def q_agg_daily_totals(spark, sf_dir):
    """Units and distinct orders per day."""
    return profile.daily_totals(profile_lines(T(spark, sf_dir)))


@register("agg_daily_moments", with_ctes(
    "SELECT 'mean_daily_qty' AS Metric, round(avg(DailyQty), 6) AS Value FROM dly "
    "UNION ALL SELECT 'std_daily_qty', round(stddev_pop(DailyQty), 6) FROM dly "
    "UNION ALL SELECT 'mean_daily_orders', round(avg(DailyOrders), 6) FROM dly "
    "UNION ALL SELECT 'std_daily_orders', round(stddev_pop(DailyOrders), 6) FROM dly "
    "UNION ALL SELECT 'mean_line_qty', round(avg(OrderQty), 6) FROM profile_lines "
    "UNION ALL SELECT 'std_line_qty', round(stddev_pop(OrderQty), 6) FROM profile_lines", "dly", "profile_lines"))
def q_agg_daily_moments(spark, sf_dir):
    """Mean and population std of daily and line-level demand."""
    return profile.daily_moments(profile_lines(T(spark, sf_dir)))


@register("agg_relative_frequency", with_ctes(
    "SELECT 'product' AS Dimension, CAST(ProductID AS BIGINT) AS Value, CAST(count(*) AS DOUBLE) / (SELECT "
    "count(*) FROM profile_lines) AS Share FROM profile_lines GROUP BY ProductID UNION ALL "
    "SELECT 'customer', CAST(CustomerID AS BIGINT), CAST(count(*) AS DOUBLE) / (SELECT count(CustomerID) FROM "
    "header_hist) FROM header_hist WHERE CustomerID IS NOT NULL GROUP BY CustomerID UNION ALL "
    "SELECT 'salesperson', CAST(SalesPersonID AS BIGINT), CAST(count(*) AS DOUBLE) / (SELECT count(SalesPersonID) "
    "FROM header_hist) FROM header_hist WHERE SalesPersonID IS NOT NULL GROUP BY SalesPersonID",
    "profile_lines", "header_hist"))
def q_agg_relative_frequency(spark, sf_dir):
    """Value shares of products (lines), customers and salespeople (orders)."""
    t = T(spark, sf_dir)
    return (profile.relative_frequency(profile_lines(t), "ProductID", "product")
            .unionByName(profile.relative_frequency(t.header_hist, "CustomerID", "customer"))
            .unionByName(profile.relative_frequency(t.header_hist, "SalesPersonID", "salesperson")))


@register("agg_product_quantiles", with_ctes(
    f"SELECT ProductID, m AS MeanQty, {floor1_sql(xpct_sql('v', 'n', '0.1'))} AS P10, "
    f"{ceil1_sql(xpct_sql('v', 'n', '0.9'))} AS P90 FROM (SELECT ProductID, avg(OrderQty) AS m, "
    "list_sort(list(OrderQty)) AS v, count(*) AS n FROM profile_lines GROUP BY ProductID) s", "profile_lines"))
def q_agg_product_quantiles(spark, sf_dir):
    """Per product mean, floor P10, ceil P90 of quantity (each >= 1)."""
    return profile.product_quantiles(profile_lines(T(spark, sf_dir)))


@register("agg_global_quantiles", with_ctes(
    f"SELECT greatest(1.0, round(m, 6)) AS MeanQty, {floor1_sql(xpct_sql('v', 'n', '0.1'))} AS P10, "
    f"{ceil1_sql(xpct_sql('v', 'n', '0.9'))} AS P90 FROM gq", "gq"))
def q_agg_global_quantiles(spark, sf_dir):
    """The same over all lines."""
    return profile.global_quantiles(profile_lines(T(spark, sf_dir)))


@register("agg_order_size_profile", with_ctes(
    f"SELECT round(l.m, 6) AS lines_mean, {floor1_sql(xpct_sql('l.v', 'l.n', '0.1'))} AS lines_p10, "
    f"greatest({floor1_sql(xpct_sql('l.v', 'l.n', '0.1'))}, CAST(ceil({xpct_sql('l.v', 'l.n', '0.9')}) AS BIGINT)) "
    f"AS lines_p90, round(q.m, 6) AS qty_mean, {floor1_sql(xpct_sql('q.v', 'q.n', '0.1'))} AS qty_p10, "
    f"greatest({floor1_sql(xpct_sql('q.v', 'q.n', '0.1'))}, CAST(ceil({xpct_sql('q.v', 'q.n', '0.9')}) AS BIGINT)) "
    "AS qty_p90 FROM oq_lines l, oq_qty q", "oq_lines", "oq_qty"))
def q_agg_order_size_profile(spark, sf_dir):
    """Lines per order and units per order: mean, P10, P90."""
    return profile.order_size_profile(profile_lines(T(spark, sf_dir)))


@register("agg_product_spread", with_ctes(
    "SELECT round(avg(greatest(1.0, m)), 6) AS product_mean_avg, round(avg(greatest(1.0, coalesce(s, 1.0))), 6) "
    "AS product_std_avg FROM per_product", "per_product"))
def q_agg_product_spread(spark, sf_dir):
    """Per-product mean and sample std (floored at 1), averaged over products."""
    return profile.product_spread(profile_lines(T(spark, sf_dir)))


@register("agg_price_moments", with_ctes(
    "SELECT coalesce(round(avg(CAST(ListPrice AS DOUBLE)), 6), 100.0) AS price_mean, "
    "coalesce(round(stddev_pop(CAST(ListPrice AS DOUBLE)), 6), 50.0) AS price_std FROM cur_price", "cur_price"))
def q_agg_price_moments(spark, sf_dir):
    """Mean and population std of current non-zero list prices."""
    return profile.price_moments(T(spark, sf_dir).price_history)


@register("agg_collect_samples", with_ctes(
    "SELECT 'product' AS Kind, CAST(ProductID AS BIGINT) AS Key, string_agg(OrderQty || ':' || n, ',' ORDER BY OrderQty) "
    "AS QtySamples FROM (SELECT ProductID, OrderQty, count(*) AS n FROM profile_lines GROUP BY ProductID, OrderQty) s "
    "GROUP BY ProductID UNION ALL "
    "SELECT 'tier', CAST(o.SpecialOfferID AS BIGINT), coalesce(string_agg(q.OrderQty || ':' || q.n, ',' ORDER BY q.OrderQty), '') "
    "FROM special_offer o LEFT JOIN (SELECT OrderQty, count(*) AS n FROM profile_lines GROUP BY OrderQty) q ON "
    "q.OrderQty >= greatest(1, o.MinQty) AND (o.MaxQty IS NULL OR q.OrderQty <= greatest(greatest(1, o.MinQty), o.MaxQty)) "
    "WHERE o.UnitPriceDiscount > 0 GROUP BY o.SpecialOfferID", "profile_lines", "special_offer"))
def q_agg_collect_samples(spark, sf_dir):
    """The quantity sample of each product and of each discounted tier (as sorted value:count pairs)."""
    t = T(spark, sf_dir)
    cells = profile.quantity_cells(profile_lines(t)).checkpoint()
    return (profile.collect_samples(cells, "ProductID").select(F.lit("product").alias("Kind"), F.col("ProductID").cast("long").alias("Key"), "QtySamples")
            .unionByName(profile.tier_samples(cells, special_offers(t))
                         .select(F.lit("tier").alias("Kind"), F.col("SpecialOfferID").cast("long").alias("Key"), "QtySamples")))


def _describe_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS Measure, count({x}) AS Count, round(avg({x}), 6) AS Mean, round(stddev_samp({x}), 6) "
            f"AS Std, min({x}) AS Min, round(quantile_cont({x}, 0.25), 6) AS P25, round(quantile_cont({x}, 0.5), 6) "
            f"AS P50, round(quantile_cont({x}, 0.75), 6) AS P75, max({x}) AS Max FROM daily_details_temp")


@register("agg_describe", with_ctes(" UNION ALL ".join(_describe_sql(c) for c in
                                                       ("OrderQty", "UnitPrice", "UnitPriceDiscount")),
                                    "daily_details_temp"))
def q_agg_describe(spark, sf_dir):
    """describe() of the staged batch's quantity, price and discount."""
    return profile.describe(T(spark, sf_dir).daily_details_temp, ["OrderQty", "UnitPrice", "UnitPriceDiscount"])


@register("agg_first_territory", with_ctes(
    "SELECT SalesPersonID, arg_min(TerritoryID, SalesOrderID) AS TerritoryID FROM header_hist WHERE "
    "SalesPersonID IS NOT NULL GROUP BY SalesPersonID", "header_hist"))
def q_agg_first_territory(spark, sf_dir):
    """One territory per salesperson, from their first order."""
    h = T(spark, sf_dir).header_hist.where(F.col("SalesPersonID").isNotNull())
    return h.groupBy("SalesPersonID").agg(F.min_by("TerritoryID", "SalesOrderID").alias("TerritoryID"))


@register("agg_max_id", with_ctes(
    "SELECT coalesce(max(SalesOrderID), 0) + 1 AS NextSalesOrderID, coalesce((SELECT max(SalesOrderDetailID) FROM "
    "detail_hist), 0) + 1 AS NextSalesOrderDetailID FROM header_hist", "header_hist", "detail_hist"))
def q_agg_max_id(spark, sf_dir):
    """Next free ids (max + 1, or 1 on an empty table)."""
    t = T(spark, sf_dir)
    nxt_d = t.detail_hist.select(F.coalesce(F.max("SalesOrderDetailID"), F.lit(0)) + 1).scalar()
    return t.header_hist.agg((F.coalesce(F.max("SalesOrderID"), F.lit(0)) + 1).alias("NextSalesOrderID")) \
                        .select("NextSalesOrderID", nxt_d.alias("NextSalesOrderDetailID"))


# ---------------------------------------------------------------------------
# §2.5 sort, limit, set operations, generators
# ---------------------------------------------------------------------------
@register("sort_desc", with_ctes("SELECT DISTINCT CustomerID FROM header_hist ORDER BY CustomerID DESC",
                                 "header_hist"))
def q_sort_desc(spark, sf_dir):
    """O1: sorted unique ids, descending."""
    return T(spark, sf_dir).header_hist.select("CustomerID").distinct().orderBy(F.col("CustomerID").desc())


@register("sort_multi_nulls_last", with_ctes(
    "SELECT ProductID, StartDate, EndDate, ListPrice FROM price_history ORDER BY ProductID DESC, EndDate ASC NULLS "
    "LAST, ListPrice DESC", "price_history"))
def q_sort_multi_nulls_last(spark, sf_dir):
    """O2: mixed directions with NULLs last."""
    p = T(spark, sf_dir).price_history
    return p.orderBy(F.col("ProductID").desc(), F.col("EndDate").asc_nulls_last(), F.col("ListPrice").desc())


@register("topk_preview", with_ctes(
    "SELECT SalesOrderID, OrderDate, SubTotal FROM header_hist ORDER BY SubTotal DESC, SalesOrderID LIMIT 10",
    "header_hist"))
def q_topk_preview(spark, sf_dir):
    """O3: top-10 orders by value (the limit is the feature; planned as TakeOrderedAndProject)."""
    h = T(spark, sf_dir).header_hist
    return h.select("SalesOrderID", "OrderDate", "SubTotal").orderBy(F.col("SubTotal").desc(),
                                                                      F.col("SalesOrderID")).limit(10)


@register("union_all_customers", with_ctes("SELECT CustomerID, CustomerType FROM dim_customer", "dim_customer"))
def q_union_all_customers(spark, sf_dir):
    """UNION ALL of the store and individual branches (duplicates kept)."""
    t = T(spark, sf_dir)
    return model.dim_customer(t.customer_src, t.store, t.person).select("CustomerID", "CustomerType")


@register("set_difference", with_ctes(
    "SELECT ProductID FROM listed_products EXCEPT SELECT ProductID FROM detail_hist", "listed_products",
    "detail_hist"))
def q_set_difference(spark, sf_dir):
    """Listed product ids minus ids sold in the history (set semantics, = SQL EXCEPT)."""
    t = T(spark, sf_dir)
    return os_.difference(_listed_products(t), _sold(t))


@register("generate_calendar", with_ctes("SELECT Date FROM calendar_orders", "calendar_orders"))
def q_generate_calendar(spark, sf_dir):
    """Every day of the order history's years, by sequence + explode (no recursion)."""
    od = F.col("OrderDate")
    h = T(spark, sf_dir).header_all
    return model.calendar_days(F.make_date(F.year(F.min(od)), F.lit(1), F.lit(1)),
                               F.make_date(F.year(F.max(od)), F.lit(12), F.lit(31)), h)


# ---------------------------------------------------------------------------
# §2.6 scalar functions
# ---------------------------------------------------------------------------
LT_SQL = ("CAST(CAST(UnitPrice * OrderQty AS DECIMAL(19,4)) * CAST(1 - UnitPriceDiscount AS DECIMAL(10,4)) AS "
          "DECIMAL(19,4))")


@register("fn_line_total", with_ctes(
    f"SELECT SalesOrderID, SalesOrderDetailID, {LT_SQL} AS LineTotal FROM daily_details_temp", "daily_details_temp"))
def q_fn_line_total(spark, sf_dir):
    """discounted line value of staged lines (money, 4 decimals)."""
    d = T(spark, sf_dir).daily_details_temp
    return d.select("SalesOrderID", "SalesOrderDetailID", fm.line_total().alias("LineTotal"))


oc.add("lines_current_cost",
       "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.LineTotal, CAST(d.LineTotal - CAST(p.StandardCost * d.OrderQty "
       "AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS Margin FROM detail_hist d JOIN product p ON p.ProductID = d.ProductID")


def _lines_current_cost(t: SalesTables):
    p = t.product.select("ProductID", "StandardCost")
    return t.detail_hist.join(p, "ProductID").select(
        "SalesOrderID", "SalesOrderDetailID", "LineTotal", fm.margin().alias("Margin"))


@register("fn_margin", with_ctes("SELECT SalesOrderID, SalesOrderDetailID, Margin FROM lines_current_cost",
                                 "lines_current_cost"))
def q_fn_margin(spark, sf_dir):
    """margin against the product's current standard cost."""
    return _lines_current_cost(T(spark, sf_dir)).select("SalesOrderID", "SalesOrderDetailID", "Margin")


@register("fn_margin_pct", with_ctes(
    "SELECT SalesOrderID, SalesOrderDetailID, CAST(CAST(Margin * 100 AS DECIMAL(10,2)) AS DOUBLE) / "
    "NULLIF(CAST(LineTotal AS DOUBLE), 0) AS MarginPct FROM lines_current_cost", "lines_current_cost"))
def q_fn_margin_pct(spark, sf_dir):
    """margin percent, rounded to 2 decimals before dividing; NULL on a zero line value."""
    m = _lines_current_cost(T(spark, sf_dir))
    return m.select("SalesOrderID", "SalesOrderDetailID", fm.margin_pct("Margin", "LineTotal").alias("MarginPct"))


oc.add("export_text", "SELECT * FROM report_export UNION ALL SELECT * FROM action_import_fixed")


def _export_text(t: SalesTables):
    return export_at_snapshot(t).unionByName(t.action_import)


def _cur_sql(col):
    from saleslens.catalog.pipelines import _currency_sql
    return _currency_sql(col)


@register("fn_parse_currency", with_ctes(
    f"SELECT Subcategory, Country, CurrentRevenues, {_cur_sql('CurrentRevenues')} AS Revenue, "
    f"{_cur_sql('CurrentGoalRevenues')} AS Goal, {_cur_sql('DeltaCurrentGoal')} AS Delta FROM export_text",
    "export_text"))
def q_fn_parse_currency(spark, sf_dir):
    """currency text -> DECIMAL(18,2); unparsable -> NULL."""
    e = _export_text(T(spark, sf_dir))
    return e.select("Subcategory", "Country", "CurrentRevenues", ft.parse_currency("CurrentRevenues").alias("Revenue"),
                    ft.parse_currency("CurrentGoalRevenues").alias("Goal"),
                    ft.parse_currency("DeltaCurrentGoal").alias("Delta"))


@register("fn_parse_percent", with_ctes(
    "SELECT Subcategory, Country, PercCurrentGoal, "
    + __import__("saleslens.catalog.pipelines", fromlist=["x"])._percent_sql("PercCurrentGoal")
    + " AS Pct FROM export_text", "export_text"))
def q_fn_parse_percent(spark, sf_dir):
    """percent text -> DECIMAL(18,4)."""
    e = _export_text(T(spark, sf_dir))
    return e.select("Subcategory", "Country", "PercCurrentGoal", ft.parse_percent("PercCurrentGoal").alias("Pct"))


@register("fn_full_name", with_ctes(
    "SELECT BusinessEntityID, concat(FirstName, ' ', LastName) AS FullName FROM person WHERE FirstName IS NOT NULL "
    "AND LastName IS NOT NULL", "person"))
def q_fn_full_name(spark, sf_dir):
    """first name, space, last name (after the not-null filter)."""
    p = T(spark, sf_dir).person.where(F.col("FirstName").isNotNull() & F.col("LastName").isNotNull())
    return p.select("BusinessEntityID", ft.full_name().alias("FullName"))


@register("fn_date_shift", with_ctes(
    f"SELECT SalesOrderID, CAST({_d(SHIFT_TO)} + CAST(datediff('day', DATE '2001-08-01', OrderDate) AS INTEGER) "
    f"AS DATE) AS ShiftedOrderDate, CAST({_d(SHIFT_TO)} + CAST(datediff('day', DATE '2001-08-01', ShipDate) AS "
    "INTEGER) AS DATE) AS ShiftedShipDate FROM header_all", "header_all"))
def q_fn_date_shift(spark, sf_dir):
    """date shift with a fixed anchor; NULL ship dates stay NULL."""
    h = T(spark, sf_dir).header_all
    return h.select("SalesOrderID", fd.shift_date("OrderDate", AS_OF, SHIFT_TO).alias("ShiftedOrderDate"),
                    fd.shift_date("ShipDate", AS_OF, SHIFT_TO).alias("ShiftedShipDate"))


@register("fn_cast_date", "SELECT o_orderkey AS SalesOrderID, CAST(o_orderdate AS DATE) AS OrderDate, "
                          "CAST(o_totalprice AS DECIMAL(19,4)) AS SubTotal FROM orders")
def q_fn_cast_date(spark, sf_dir):
    """F8: datetime -> date and double -> money casts on the raw orders."""
    o = T(spark, sf_dir).raw("orders")
    return o.select(F.col("o_orderkey").alias("SalesOrderID"), fd.to_day("o_orderdate").alias("OrderDate"),
                    F.col("o_totalprice").cast(fm.MONEY).alias("SubTotal"))


@register("fn_date_parts", with_ctes(
    "SELECT SalesOrderID, CAST(year(OrderDate) AS INTEGER) AS Year, CAST(month(OrderDate) AS INTEGER) AS Month, "
    "CAST(quarter(OrderDate) AS INTEGER) AS Quarter "
    "FROM header_all", "header_all"))
def q_fn_date_parts(spark, sf_dir):
    """year, month, quarter."""
    d = F.col("OrderDate")
    return T(spark, sf_dir).header_all.select("SalesOrderID", F.year(d).alias("Year"), F.month(d).alias("Month"),
                                              F.quarter(d).alias("Quarter"))


@register("fn_period_starts", with_ctes(
    "SELECT SalesOrderID, CAST(date_trunc('quarter', OrderDate) AS DATE) AS QuarterStart, "
    "CAST(date_trunc('month', OrderDate) AS DATE) AS MonthStart FROM header_all", "header_all"))
def q_fn_period_starts(spark, sf_dir):
    """quarter start and month start."""
    return T(spark, sf_dir).header_all.select("SalesOrderID", fd.quarter_start("OrderDate").alias("QuarterStart"),
                                              fd.month_start("OrderDate").alias("MonthStart"))


@register("fn_year_bounds", with_ctes(
    "SELECT d AS AsOf, make_date(year(d), 1, 1) AS YearStart, make_date(year(d) - 1, 1, 1) AS PriorYearStart, "
    "CAST(d + 1 AS DATE) AS NextDay, CAST(datediff('day', make_date(year(d) - 1, 1, 1), make_date(year(d), 1, 1)) "
    "AS INTEGER) AS DaysInPriorYear, CAST(datediff('day', make_date(year(d), 1, 1), d) + 1 AS INTEGER) AS "
    "ElapsedDays FROM (SELECT DISTINCT "
    "OrderDate AS d FROM header_all) s", "header_all"))
def q_fn_year_bounds(spark, sf_dir):
    """year bounds, day after, days in prior year and elapsed days for every order date."""
    d = T(spark, sf_dir).header_all.select(F.col("OrderDate").alias("AsOf")).distinct()
    a = F.col("AsOf")
    return d.select("AsOf", fd.year_start(a).alias("YearStart"), fd.year_start(a, 1).alias("PriorYearStart"),
                    fd.day_after(a).alias("NextDay"), fd.days_in_prior_year(a).alias("DaysInPriorYear"),
                    fd.elapsed_days_inclusive(a).alias("ElapsedDays"))


@register("fn_safe_divide", with_ctes(
    "SELECT TerritoryID, CAST(CurrentRevenue AS DOUBLE) / NULLIF(CAST(PreviousYearRevenue AS DOUBLE), 0.0) AS "
    "GrowthRatio FROM (SELECT TerritoryID, SUM(CASE WHEN year(OrderDate) = 2001 THEN LineTotal ELSE 0 END) AS "
    "CurrentRevenue, SUM(CASE WHEN year(OrderDate) = 2000 THEN LineTotal ELSE 0 END) AS PreviousYearRevenue "
    "FROM fact GROUP BY TerritoryID) s", "fact"))
def q_fn_safe_divide(spark, sf_dir):
    """NULLIF-guarded ratio (a year without sales gives NULL, not an error)."""
    f = sales_fact(T(spark, sf_dir))
    y = F.year("OrderDate")
    z = F.lit(0).cast(fm.MONEY)
    s = f.groupBy("TerritoryID").agg(F.sum(F.when(y == 2001, F.col("LineTotal")).otherwise(z)).alias("c"),
                                     F.sum(F.when(y == 2000, F.col("LineTotal")).otherwise(z)).alias("p"))
    return s.select("TerritoryID", fm.safe_ratio("c", "p").alias("GrowthRatio"))


@register("fn_sale_price", with_ctes(
    "SELECT ProductID, CASE WHEN ListPrice > 0 THEN CAST(round(ListPrice * CAST(0.60 AS DECIMAL(3,2)), 2) AS "
    "DECIMAL(19,4)) END AS SalePrice FROM price_history WHERE EndDate IS NULL", "price_history"))
def q_fn_sale_price(spark, sf_dir):
    """simulated sale price from the current list price."""
    p = T(spark, sf_dir).price_history.where(F.col("EndDate").isNull())
    return p.select("ProductID", fm.sale_price("ListPrice").alias("SalePrice"))


@register("fn_coerce_numeric", with_ctes(
    "SELECT Subcategory, Country, coalesce(TRY_CAST(replace(replace(CurrentRevenues, '€ ', ''), ',', '') AS DOUBLE), "
    "0.0) AS Revenue FROM export_text", "export_text"))
def q_fn_coerce_numeric(spark, sf_dir):
    """text that is not a number becomes 0."""
    e = _export_text(T(spark, sf_dir))
    cleaned = F.replace(F.replace(F.col("CurrentRevenues"), F.lit("€ "), F.lit("")), F.lit(","), F.lit(""))
    return e.select("Subcategory", "Country", fm.coerce_numeric(cleaned, 0.0, "double").alias("Revenue"))
