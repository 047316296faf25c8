"""The sales data model, derived from the provided TPC-H-style tables.

Each property is a lazy DataFrame with the schema the pipeline expects
(FIXTURES.md). Nothing here is collected; Catalyst prunes the columns and
pushes the filters of whatever query consumes these frames down to the
Parquet scans.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.money import MONEY, line_total

# Fixed values of the fixture model.
AS_OF = dt.date(2001, 8, 1)          # latest order date at every scale
HISTORY_END = dt.date(2001, 7, 1)    # later orders form the staging batch
PERSON_ID_OFFSET = 1000000

# Cost / price validity intervals: (k, StartDate, EndDate, factor of retail price).
INTERVALS = [
    (0, "1995-01-01", "1997-06-30", "0.20"),
    (1, "1997-07-01", "1999-06-30", "0.25"),
    (2, "1999-07-01", "2000-12-31", "0.30"),
]

# Special offers: (SpecialOfferID, MinQty, MaxQty, Description, UnitPriceDiscount).
SPECIAL_OFFERS = [
    (1, 0, None, "none", "0.0000"),
    (2, 11, 14, "tier 11", "0.0200"),
    (3, 15, 24, "tier 15", "0.0500"),
    (4, 25, 40, "tier 25", "0.1000"),
    (5, 41, 60, "tier 41", "0.1500"),
    (6, 61, None, "tier 61", "0.2000"),
    (7, 0, None, "outside filter", "0.3500"),
]

# Product categories: (ProductCategoryID, Name).
CATEGORIES = [(0, "CAT_0"), (1, "CAT_1"), (2, "CAT_2"), (3, "CAT_3")]

# Rows of a commercial-action report export, with the dirty text it can carry.
ACTION_IMPORT_ROWS = [
    ("Brand#1", "NATION_1", "€ 120,450.00", "€ 300,900.50", "-59.97%", "-€ 180,450.50", "High"),
    ("Brand#2", "NATION_2", "€ 1,000.50", "€ 900.00", "11.17%", "€ 100.50", "Low"),
    ("Brand#3", "NATION_3", "n/a", "€ 10.00", "", "-€ 10.00", "Medium"),
    ("Brand#4", "NOWHERE", "€ 50.00", "€ 75.00", "-33.33%", "-€ 25.00", None),
    ("Brand#5", "NATION_5", '"€ 70.005"', "€ 80.00", '"1,234.5%"', "-€ 10.00", "High"),
]
ACTION_IMPORT_COLUMNS = ["Subcategory", "Country", "CurrentRevenues", "CurrentGoalRevenues",
                         "PercCurrentGoal", "DeltaCurrentGoal", "PriorityType"]


# The declared schemas of the source tables (no footer inference at read time).
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _brand_number(c: str = "p_brand"):
    return F.replace(F.col(c), F.lit("Brand#"), F.lit("")).cast("int")


def _dec(v: str, t: str):
    return F.lit(v).cast(t)


class SalesTables:
    """Lazy DataFrames of the sales model over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    _shared: dict[tuple[str, str], "SalesTables"] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "SalesTables":
        """The model for this session and directory, built once (its frames are lazy and immutable)."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    def raw(self, name: str) -> DataFrame:
        """One DataFrame per source table (schema read once)."""
        if name not in self._raw:
            reader = self.spark.read
            if name in SOURCE_SCHEMAS:
                reader = reader.schema(SOURCE_SCHEMAS[name])
            df = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            self._raw[name] = df
        return self._raw[name]

    # ---- reference data -------------------------------------------------
    @cached_property
    def territory(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                 .select(F.col("n_nationkey").cast("int").alias("TerritoryID"),
                         F.col("n_name").alias("Name"), F.col("r_name").alias("GroupName")))

    @cached_property
    def sales_person(self) -> DataFrame:
        return (self.raw("supplier").where(F.col("s_suppkey") < 10)
                .select(F.col("s_suppkey").alias("BusinessEntityID"),
                        F.col("s_nationkey").cast("int").alias("TerritoryID"),
                        _dec("0.01", "decimal(10,4)").alias("CommissionPCT")))

    @cached_property
    def customer_src(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            k.alias("CustomerID"),
            F.when((k % 3 != 0) | (k % 30 == 0), k + PERSON_ID_OFFSET).alias("PersonID"),
            F.when(k % 3 == 0, k).alias("StoreID"),
            F.col("c_nationkey").cast("int").alias("TerritoryID"))

    @cached_property
    def store(self) -> DataFrame:
        k = F.col("c_custkey")
        return (self.raw("customer").where(k % 3 == 0)
                .select(k.alias("BusinessEntityID"),
                        F.when(k % 33 == 0, F.lit(None).cast("string"))
                         .otherwise(F.concat(F.lit("Store "), F.col("c_name"))).alias("Name"),
                        (k % 10).alias("SalesPersonID")))

    @cached_property
    def person(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            (k + PERSON_ID_OFFSET).alias("BusinessEntityID"),
            F.col("c_mktsegment").alias("FirstName"),
            F.when(k % 40 == 2, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("LastName"))

    @cached_property
    def product(self) -> DataFrame:
        k = F.col("p_partkey")
        rp = F.col("p_retailprice").cast("decimal(11,2)")
        return self.raw("part").select(
            k.alias("ProductID"), F.col("p_name").alias("Name"),
            F.when(k % 50 == 0, F.lit(None).cast("int")).otherwise(_brand_number()).alias("ProductSubcategoryID"),
            F.col("p_size").cast("int").alias("DaysToManufacture"),
            F.lit(1000).alias("SafetyStockLevel"), F.lit(750).alias("ReorderPoint"),
            (rp * _dec("0.30", "decimal(3,2)")).cast(MONEY).alias("StandardCost"),
            F.col("p_retailprice").cast(MONEY).alias("ListPrice"))

    @cached_property
    def product_subcategory(self) -> DataFrame:
        b = _brand_number()
        return (self.raw("part").select(b.alias("ProductSubcategoryID"), (b % 4).alias("ProductCategoryID"),
                                        F.col("p_brand").alias("Name"))
                .distinct())

    @cached_property
    def product_category(self) -> DataFrame:
        return self.spark.createDataFrame(CATEGORIES, "ProductCategoryID int, Name string")

    @cached_property
    def special_offer_src(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(i, lo, hi, d, disc) for i, lo, hi, d, disc in SPECIAL_OFFERS],
            "SpecialOfferID int, MinQty int, MaxQty int, Description string, UnitPriceDiscount string",
        ).withColumn("UnitPriceDiscount", F.col("UnitPriceDiscount").cast("decimal(10,4)"))

    @cached_property
    def action_import(self) -> DataFrame:
        return self.spark.createDataFrame(
            ACTION_IMPORT_ROWS, ", ".join(f"{c} string" for c in ACTION_IMPORT_COLUMNS))

    # ---- SCD-2 histories ------------------------------------------------
    def _intervals(self):
        """The validity intervals as a generator column: 3 rows per product, no join."""
        return F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(s).cast("date").alias("StartDate"),
                     F.lit(e).cast("date").alias("EndDate"), _dec(f, "decimal(3,2)").alias("f"))
            for k, s, e, f in INTERVALS])).alias("iv")

    @cached_property
    def cost_history_raw(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_retailprice", self._intervals())
        return (p.where(~((F.col("p_partkey") % 20 == 0) & (F.col("iv.k") == 0)))
                 .select(F.col("p_partkey").alias("ProductID"), F.col("iv.StartDate").alias("StartDate"),
                         F.col("iv.EndDate").alias("EndDate"),
                         (F.col("p_retailprice").cast("decimal(11,2)") * F.col("iv.f")).cast(MONEY)
                         .alias("StandardCost")))

    @cached_property
    def price_history_raw(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_retailprice", self._intervals())
        return p.select(F.col("p_partkey").alias("ProductID"), F.col("iv.StartDate").alias("StartDate"),
                        F.col("iv.EndDate").alias("EndDate"),
                        (F.col("p_retailprice").cast("decimal(11,2)")
                         * (F.col("iv.f") + _dec("0.50", "decimal(3,2)"))).cast(MONEY).alias("ListPrice"))

    @cached_property
    def cost_history(self) -> DataFrame:
        from saleslens.plans.model import open_latest
        return open_latest(self.cost_history_raw)

    @cached_property
    def price_history(self) -> DataFrame:
        from saleslens.plans.model import open_latest
        return open_latest(self.price_history_raw)

    # ---- orders -----------------------------------------------------------
    @cached_property
    def header_all(self) -> DataFrame:
        o, c = self.raw("orders"), self.raw("customer").select("c_custkey", "c_nationkey")
        k = F.col("o_orderkey")
        od = F.col("o_orderdate").cast("date")
        online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        due = (k % 6 + 2).cast("int")
        return (o.join(c, o.o_custkey == c.c_custkey)
                 .select(k.alias("SalesOrderID"), od.alias("OrderDate"),
                         F.date_add(od, due).alias("DueDate"),
                         F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("date"))
                          .otherwise(F.date_add(od, (due + k % 5).cast("int"))).alias("ShipDate"),
                         online.alias("OnlineOrderFlag"), F.col("o_custkey").alias("CustomerID"),
                         F.when(online, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey") % 10)
                          .alias("SalesPersonID"),
                         F.col("c_nationkey").cast("int").alias("TerritoryID"),
                         F.col("o_totalprice").cast(MONEY).alias("SubTotal"),
                         F.lit(AS_OF).alias("modified_date")))

    @cached_property
    def detail_base(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("SalesOrderID"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("SalesOrderDetailID"),
            F.col("l_quantity").cast("smallint").alias("OrderQty"),
            F.col("l_partkey").alias("ProductID"),
            (F.col("l_extendedprice").cast("decimal(11,2)") * _dec("0.01", "decimal(3,2)")).cast(MONEY)
            .alias("UnitPrice"),
            F.col("l_discount").cast(MONEY).alias("UnitPriceDiscount"))

    @cached_property
    def detail_all(self) -> DataFrame:
        q = F.col("OrderQty")
        tier = (F.when(q >= 41, 5).when(q >= 25, 4).when(q >= 15, 3).when(q >= 11, 2).otherwise(1))
        return self.detail_base.select("*", line_total().alias("LineTotal"), tier.alias("SpecialOfferID"))

    @cached_property
    def header_hist(self) -> DataFrame:
        return self.header_all.where(F.col("OrderDate") <= F.lit(HISTORY_END))

    @cached_property
    def detail_hist(self) -> DataFrame:
        # Lines whose order is in history; the header side is unique per order.
        return self.detail_all.join(self.header_hist.select("SalesOrderID"), "SalesOrderID", "left_semi")

    @cached_property
    def orders_temp(self) -> DataFrame:
        return (self.header_all.where(F.col("OrderDate") > F.lit(HISTORY_END))
                .select("SalesOrderID", "OrderDate", "DueDate", "ShipDate", "OnlineOrderFlag", "CustomerID",
                        "SalesPersonID", "TerritoryID", (F.col("SalesOrderID") % 4 == 0).alias("processed"),
                        F.col("OrderDate").alias("modified_date")))

    @cached_property
    def daily_details_temp(self) -> DataFrame:
        return self.lines_of(self.orders_temp.select("SalesOrderID", "modified_date"))

    def lines_of(self, t: DataFrame) -> DataFrame:
        """The staged lines of the orders t (SalesOrderID, modified_date)."""
        d = self.detail_all
        return (d.join(t, "SalesOrderID")
                 .select("SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "SpecialOfferID",
                         "UnitPrice", "UnitPriceDiscount",
                         (F.col("UnitPrice") * F.col("OrderQty")).cast(MONEY).alias("LineTotal"),
                         "modified_date"))

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")
