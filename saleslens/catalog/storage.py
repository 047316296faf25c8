"""Registered variants of S1, S5, D8 and G12 to G14: damaged rows, tables replaced by part, distinct counts and quantiles
from stored parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslens.catalog import ORACLES, register
from saleslens.catalog import insights as _insights  # noqa: F401  (D8's oracle is used below)
from saleslens.catalog import oracle_ctes as oc
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.catalog.pipelines import FACT_SELECT, loaded_batch, profile_lines, sales_fact
from saleslens.operators import bitmaps, sketches
from saleslens.session import fresh_dir
from saleslens.sources import partitioned, quarantine
from saleslens.sources.fixtures import SalesTables

# The fact's definition over the tables after the daily load.
oc.add("fact_rows_loaded", oc.CTES["fact_base"].replace("detail_hist", "detail_after_load").replace("header_hist", "header_after_load"))
oc.add("fact_after_load", oc.CTES["fact"].replace("fact_base", "fact_rows_loaded"))

_LINE = "concat_ws(',', SalesOrderID, ProductID, OrderQty, UnitPrice)"
#: How every tenth line of the file is damaged, by its product: a field less, one more, a quote left open.
_DAMAGE = {0: "concat_ws(',', SalesOrderID, ProductID, OrderQty)", 1: f"concat({_LINE}, ',')", 2: f"concat('\"', {_LINE})"}
_REASON = {0: "short", 1: "long", 2: "quotes"}
_BROKEN = "SalesOrderDetailID % 10 = 3"


def _case(values: dict[int, str]) -> str:
    return "CASE ProductID % 3 " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + " END"


@register("src_csv_quarantine", with_ctes(
    f"SELECT {_case(_DAMAGE)} AS Line, {_case({k: repr(v) for k, v in _REASON.items()})} AS Reason FROM detail_hist "
    f"WHERE {_BROKEN} UNION ALL SELECT {_LINE}, NULL FROM detail_hist WHERE NOT ({_BROKEN})", "detail_hist"))
def q_src_csv_quarantine(spark, sf_dir):
    """An export of the order lines with damaged lines in it, each line with the reason why it is kept apart."""
    d = SalesTables.of(spark, sf_dir).detail_hist
    line = F.expr(f"CASE WHEN {_BROKEN} THEN {_case(_DAMAGE)} ELSE {_LINE} END")
    path = fresh_dir(spark, "damaged-csv")
    d.select(line.alias("value")).write.option("quote", "").option("escape", "\x01").option("sep", "\x01") \
        .option("header", True).csv(path)
    return quarantine.judged(spark, path, ["SalesOrderID", "ProductID", "OrderQty", "UnitPrice"]).select("Line", "Reason")


@register("sink_overwrite_partitions", with_ctes(f"SELECT {FACT_SELECT} FROM fact_after_load", "fact_after_load"))
def q_sink_overwrite_partitions(spark, sf_dir):
    """The fact stored by order year; after the daily load the years of the batch are written again, the others stay.
    The guard keeps a batch's orders apart from the history's, so a year after the load is its stored rows and the batch's
    fact: the history's lines are joined once."""
    t = SalesTables.of(spark, sf_dir)
    fact = partitioned.by_year(sales_fact(t))
    path = partitioned.write_partitioned(fact, fresh_dir(spark, "fact-by-year"), "OrderYear", rebalance=False)
    store, batch = loaded_batch(spark, t)
    years = store.read("orders_temp").select(F.year("OrderDate").alias("OrderYear")).distinct()
    loaded = partitioned.read_partitioned(spark, path, fact.schema).unionByName(partitioned.by_year(batch))
    partitioned.replace_parts(loaded.join(F.broadcast(years), "OrderYear", "left_semi").select(*fact.columns), path, "OrderYear", rebalance=False)
    return partitioned.read_partitioned(spark, path, fact.schema).drop("OrderYear")


@register("doc_cohort_retention_bitmaps", ORACLES["doc_cohort_retention"])
def q_doc_cohort_retention_bitmaps(spark, sf_dir):
    """The cohort table from stored customer bitmaps; the last year's months are added without reading earlier orders."""
    header = SalesTables.of(spark, sf_dir).header_hist
    stored = lambda h: bitmaps.month_customers(h).withColumn("OrderYear", F.year("Month"))
    last = header.select(F.year(F.max("OrderDate"))).scalar()
    first = stored(header.where(F.year("OrderDate") < last))
    path = partitioned.write_partitioned(first, fresh_dir(spark, "customer-bitmaps"), "OrderYear")
    partitioned.replace_parts(stored(header.where(F.year("OrderDate") == last)), path, "OrderYear")
    return bitmaps.cohorts(partitioned.read_partitioned(spark, path, first.schema).drop("OrderYear"))


def _stored_days(spark, sf_dir, of_lines):
    """The sketches of the history up to its last day, stored by day, with those of the last day added."""
    lines = profile_lines(SalesTables.of(spark, sf_dir))
    last = lines.select(F.max("OrderDate")).scalar()
    history = of_lines(lines.where(F.col("OrderDate") < last))
    path = partitioned.write_partitioned(history, fresh_dir(spark, "sketches"), "OrderDate")
    partitioned.replace_parts(of_lines(lines.where(F.col("OrderDate") == last)), path, "OrderDate")
    return partitioned.read_partitioned(spark, path, history.schema)


# The least value whose rank is at least the share, in whole numbers. Products have fewer lines here than a sketch holds.
_RANKED = ("SELECT ProductID, OrderQty, row_number() OVER (PARTITION BY ProductID ORDER BY OrderQty) AS i, "
           "count(*) OVER (PARTITION BY ProductID) AS n FROM profile_lines WHERE OrderQty IS NOT NULL")


@register("agg_product_quantiles_sketched", with_ctes(
    "SELECT ProductID, count(*) AS Lines, CAST(sum(OrderQty) AS DOUBLE) / count(*) AS MeanQty, "
    "CAST(greatest(1, min(CASE WHEN 10 * i >= n THEN OrderQty END)) AS BIGINT) AS P10, "
    f"CAST(greatest(1, min(CASE WHEN 10 * i >= 9 * n THEN OrderQty END)) AS BIGINT) AS P90 FROM ({_RANKED}) r GROUP BY ProductID",
    "profile_lines"))
def q_agg_product_quantiles_sketched(spark, sf_dir):
    """G12 from stored sketches of each day and product; the last day is added without reading earlier lines."""
    return sketches.product_quantiles(_stored_days(spark, sf_dir, sketches.product_days))


@register("agg_global_quantiles_sketched")
def q_agg_global_quantiles_sketched(spark, sf_dir):
    """G13 from the same sketches, merged over all products and days: approximate in rank."""
    return sketches.global_quantiles(_stored_days(spark, sf_dir, sketches.product_days))


@register("agg_order_size_profile_sketched")
def q_agg_order_size_profile_sketched(spark, sf_dir):
    """G14 from stored sketches of each day's orders: approximate in rank."""
    return sketches.order_size_profile(_stored_days(spark, sf_dir, sketches.order_days))
