"""Named SQL building blocks for the DuckDB oracle.

Only the raw tables are registered on the oracle side, so each oracle query
carries the model definitions it needs as CTEs. ``with_ctes(body, *names)``
prepends the named CTEs and everything they depend on, in dependency order.
These are fixed definitions of the test model (FIXTURES.md), kept as text.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"
HISTORY_END = "DATE '2001-07-01'"

CTES: dict[str, str] = {
    "territory": "SELECT CAST(n_nationkey AS INTEGER) AS TerritoryID, n_name AS Name, r_name AS GroupName "
                 "FROM nation JOIN region ON r_regionkey = n_regionkey",
    "sales_person": "SELECT s_suppkey AS BusinessEntityID, CAST(s_nationkey AS INTEGER) AS TerritoryID, "
                    "CAST(0.01 AS DECIMAL(10,4)) AS CommissionPCT FROM supplier WHERE s_suppkey < 10",
    "customer_src": "SELECT c_custkey AS CustomerID, CASE WHEN c_custkey % 3 <> 0 OR c_custkey % 30 = 0 "
                    "THEN c_custkey + 1000000 END AS PersonID, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END "
                    "AS StoreID, CAST(c_nationkey AS INTEGER) AS TerritoryID FROM customer",
    "store": "SELECT c_custkey AS BusinessEntityID, CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE "
             "concat('Store ', c_name) END AS Name, c_custkey % 10 AS SalesPersonID FROM customer "
             "WHERE c_custkey % 3 = 0",
    "person": "SELECT c_custkey + 1000000 AS BusinessEntityID, c_mktsegment AS FirstName, CASE WHEN "
              "c_custkey % 40 = 2 THEN NULL ELSE c_name END AS LastName FROM customer",
    "product": "SELECT p_partkey AS ProductID, p_name AS Name, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE "
               "CAST(replace(p_brand, 'Brand#', '') AS INT) END AS ProductSubcategoryID, CAST(p_size AS INT) AS "
               "DaysToManufacture, 1000 AS SafetyStockLevel, 750 AS ReorderPoint, CAST(CAST(p_retailprice AS "
               "DECIMAL(11,2)) * CAST(0.30 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS StandardCost, "
               "CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice FROM part",
    "product_subcategory": "SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS INT) AS ProductSubcategoryID, "
                           "CAST(replace(p_brand, 'Brand#', '') AS INT) % 4 AS ProductCategoryID, p_brand AS Name "
                           "FROM part",
    "product_category": "SELECT * FROM (VALUES (0,'CAT_0'),(1,'CAT_1'),(2,'CAT_2'),(3,'CAT_3')) "
                        "AS v(ProductCategoryID, Name)",
    "interval_k": "SELECT * FROM (VALUES (0, DATE '1995-01-01', DATE '1997-06-30', CAST(0.20 AS DECIMAL(3,2))), "
                  "(1, DATE '1997-07-01', DATE '1999-06-30', CAST(0.25 AS DECIMAL(3,2))), "
                  "(2, DATE '1999-07-01', DATE '2000-12-31', CAST(0.30 AS DECIMAL(3,2)))) "
                  "AS v(k, StartDate, EndDate, f)",
    "cost_history_raw": "SELECT p_partkey AS ProductID, StartDate, EndDate, CAST(CAST(p_retailprice AS "
                        "DECIMAL(11,2)) * f AS DECIMAL(19,4)) AS StandardCost FROM part CROSS JOIN interval_k "
                        "WHERE NOT (p_partkey % 20 = 0 AND k = 0)",
    "price_history_raw": "SELECT p_partkey AS ProductID, StartDate, EndDate, CAST(CAST(p_retailprice AS "
                         "DECIMAL(11,2)) * (f + CAST(0.50 AS DECIMAL(3,2))) AS DECIMAL(19,4)) AS ListPrice "
                         "FROM part CROSS JOIN interval_k",
    "cost_history": "SELECT ProductID, StartDate, CASE WHEN StartDate = max(StartDate) OVER (PARTITION BY "
                    "ProductID) THEN NULL ELSE EndDate END AS EndDate, StandardCost FROM cost_history_raw",
    "price_history": "SELECT ProductID, StartDate, CASE WHEN StartDate = max(StartDate) OVER (PARTITION BY "
                     "ProductID) THEN NULL ELSE EndDate END AS EndDate, ListPrice FROM price_history_raw",
    "special_offer_src": "SELECT * FROM (VALUES (1, 0, CAST(NULL AS INT), 'none', CAST(0.0000 AS DECIMAL(10,4))), "
                         "(2, 11, 14, 'tier 11', CAST(0.0200 AS DECIMAL(10,4))), "
                         "(3, 15, 24, 'tier 15', CAST(0.0500 AS DECIMAL(10,4))), "
                         "(4, 25, 40, 'tier 25', CAST(0.1000 AS DECIMAL(10,4))), "
                         "(5, 41, 60, 'tier 41', CAST(0.1500 AS DECIMAL(10,4))), "
                         "(6, 61, CAST(NULL AS INT), 'tier 61', CAST(0.2000 AS DECIMAL(10,4))), "
                         "(7, 0, CAST(NULL AS INT), 'outside filter', CAST(0.3500 AS DECIMAL(10,4)))) "
                         "AS v(SpecialOfferID, MinQty, MaxQty, Description, UnitPriceDiscount)",
    "special_offer": "SELECT * FROM special_offer_src WHERE SpecialOfferID < 7",
    "header_all": "SELECT o_orderkey AS SalesOrderID, CAST(o_orderdate AS DATE) AS OrderDate, "
                  "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 + 2 AS INT) AS DATE) AS DueDate, "
                  "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + "
                  "CAST(o_orderkey % 6 + 2 + o_orderkey % 5 AS INT) AS DATE) END AS ShipDate, "
                  "o_orderpriority IN ('1-URGENT', '2-HIGH') AS OnlineOrderFlag, o_custkey AS CustomerID, "
                  "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o_custkey % 10 END AS "
                  "SalesPersonID, CAST(c_nationkey AS INTEGER) AS TerritoryID, CAST(o_totalprice AS DECIMAL(19,4)) "
                  "AS SubTotal, DATE '2001-08-01' AS modified_date FROM orders JOIN customer ON c_custkey = o_custkey",
    "detail_base": "SELECT l_orderkey AS SalesOrderID, l_orderkey * 8 + l_linenumber AS SalesOrderDetailID, "
                   "CAST(l_quantity AS SMALLINT) AS OrderQty, l_partkey AS ProductID, CAST(CAST(l_extendedprice "
                   "AS DECIMAL(11,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS UnitPrice, "
                   "CAST(l_discount AS DECIMAL(19,4)) AS UnitPriceDiscount FROM lineitem",
    "detail_all": "SELECT *, CAST(CAST(UnitPrice * OrderQty AS DECIMAL(19,4)) * CAST(1 - UnitPriceDiscount AS "
                  "DECIMAL(10,4)) AS DECIMAL(19,4)) AS LineTotal, CASE WHEN OrderQty >= 41 THEN 5 WHEN OrderQty "
                  ">= 25 THEN 4 WHEN OrderQty >= 15 THEN 3 WHEN OrderQty >= 11 THEN 2 ELSE 1 END AS "
                  "SpecialOfferID FROM detail_base",
    "header_hist": f"SELECT * FROM header_all WHERE OrderDate <= {HISTORY_END}",
    "detail_hist": "SELECT d.* FROM detail_all d JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID",
    "orders_temp": "SELECT SalesOrderID, OrderDate, DueDate, ShipDate, OnlineOrderFlag, CustomerID, SalesPersonID, "
                   "TerritoryID, SalesOrderID % 4 = 0 AS processed, OrderDate AS modified_date FROM header_all "
                   f"WHERE OrderDate > {HISTORY_END}",
    "daily_details_temp": "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, d.ProductID, d.SpecialOfferID, "
                          "d.UnitPrice, d.UnitPriceDiscount, CAST(d.UnitPrice * d.OrderQty AS DECIMAL(19,4)) AS "
                          "LineTotal, t.modified_date FROM detail_all d JOIN orders_temp t ON "
                          "d.SalesOrderID = t.SalesOrderID",
    "action_import_fixed": "SELECT * FROM (VALUES ('Brand#1','NATION_1','€ 120,450.00','€ 300,900.50','-59.97%',"
                           "'-€ 180,450.50','High'), ('Brand#2','NATION_2','€ 1,000.50','€ 900.00','11.17%',"
                           "'€ 100.50','Low'), ('Brand#3','NATION_3','n/a','€ 10.00','','-€ 10.00','Medium'), "
                           "('Brand#4','NOWHERE','€ 50.00','€ 75.00','-33.33%','-€ 25.00',CAST(NULL AS VARCHAR)), "
                           "('Brand#5','NATION_5','\"€ 70.005\"','€ 80.00','\"1,234.5%\"','-€ 10.00','High')) "
                           "AS v(Subcategory, Country, CurrentRevenues, CurrentGoalRevenues, PercCurrentGoal, "
                           "DeltaCurrentGoal, PriorityType)",
    # ---- derived model -------------------------------------------------------
    "dim_product": "SELECT p.ProductID, p.Name AS Product, sc.Name AS Subcategory, c.Name AS Category "
                   "FROM product p LEFT JOIN product_subcategory sc ON p.ProductSubcategoryID = "
                   "sc.ProductSubcategoryID LEFT JOIN product_category c ON sc.ProductCategoryID = "
                   "c.ProductCategoryID",
    "dim_customer": "SELECT c.CustomerID, s.Name AS CustomerName, 'Store' AS CustomerType FROM customer_src c "
                    "JOIN store s ON c.StoreID = s.BusinessEntityID WHERE s.Name IS NOT NULL UNION ALL "
                    "SELECT c.CustomerID, concat(p.FirstName, ' ', p.LastName) AS CustomerName, 'Individual' AS "
                    "CustomerType FROM customer_src c JOIN person p ON c.PersonID = p.BusinessEntityID "
                    "WHERE p.FirstName IS NOT NULL AND p.LastName IS NOT NULL",
    "fact_base": "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, d.ProductID, d.UnitPrice, "
                 "d.UnitPriceDiscount, d.LineTotal, d.SpecialOfferID, h.OrderDate, h.DueDate, h.ShipDate, "
                 "h.OnlineOrderFlag, h.CustomerID, c.StandardCost, h.SalesPersonID, h.TerritoryID, h.modified_date, "
                 "CAST(d.LineTotal - CAST(c.StandardCost * d.OrderQty AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS "
                 "ProductMargin FROM detail_hist d JOIN header_hist h ON d.SalesOrderID = h.SalesOrderID "
                 "JOIN cost_history c ON d.ProductID = c.ProductID AND h.OrderDate >= c.StartDate AND "
                 "h.OrderDate <= coalesce(c.EndDate, DATE '9999-12-31')",
    "fact": "SELECT *, CAST(CAST(ProductMargin * 100 AS DECIMAL(10,2)) AS DOUBLE) / NULLIF(CAST(LineTotal AS "
            "DOUBLE), 0) AS ProductMarginPct FROM fact_base",
    "profile_lines": "SELECT OrderDate, SalesOrderID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount FROM detail_hist JOIN header_hist USING "
                     "(SalesOrderID) SEMI JOIN (SELECT DISTINCT ProductID FROM cost_history_raw) costed USING "
                     "(ProductID) WHERE OrderDate >= DATE '2000-01-01'",
}

_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def add(name: str, sql: str) -> None:
    CTES[name] = sql


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [t for t in dict.fromkeys(_NAME_RE.findall(body)) if t in CTES and t != name]


def with_ctes(body: str, *names: str) -> str:
    """``WITH <closure of names in dependency order> <body>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    wanted = list(names) or [t for t in dict.fromkeys(_NAME_RE.findall(body)) if t in CTES]
    for n in wanted:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body
