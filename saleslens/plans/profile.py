"""Demand profile of the order history (W18, G9-G18) and offer assignment.

All statistics are Spark aggregates with map-side partial aggregation; the
exact percentiles run on integer quantities/counts, whose distinct values are
few, so their per-group state stays small even for a key holding much of the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from saleslens.functions.dates import as_date
from saleslens.operators.aggregates import exact_percentiles

# Fixed value: history considered by the profile starts here on the fixtures.
PROFILE_START = dt.date(2000, 1, 1)


def profile_lines(header: DataFrame, detail: DataFrame, cost_history: DataFrame, start=PROFILE_START) -> DataFrame:
    """Lines from ``start`` on whose product has a cost (P7 + J1 + J7)."""
    h = header.where(F.col("OrderDate").isNotNull() & (F.col("OrderDate") >= as_date(start))) \
              .select("SalesOrderID", "OrderDate")
    d = detail.join(cost_history.select("ProductID"), "ProductID", "left_semi") \
              .select("SalesOrderID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount")
    return h.join(d, "SalesOrderID").select("OrderDate", "SalesOrderID", "OrderQty", "ProductID", "UnitPrice",
                                            "UnitPriceDiscount")


def daily_totals(lines: DataFrame) -> DataFrame:
    """Per order date, units and distinct orders."""
    return lines.groupBy("OrderDate").agg(F.sum("OrderQty").alias("DailyQty"),
                                          F.count_distinct("SalesOrderID").alias("DailyOrders"))


def _r(c, n=6):
    return F.round(c, n)


def daily_moments(lines: DataFrame) -> DataFrame:
    """Mean and population std of daily units, daily orders and line quantity (long form)."""
    d = daily_totals(lines)
    a = d.agg(_r(F.avg("DailyQty")).alias("mean_daily_qty"), _r(F.stddev_pop("DailyQty")).alias("std_daily_qty"),
              _r(F.avg("DailyOrders")).alias("mean_daily_orders"),
              _r(F.stddev_pop("DailyOrders")).alias("std_daily_orders"))
    b = lines.agg(_r(F.avg("OrderQty")).alias("mean_line_qty"), _r(F.stddev_pop("OrderQty")).alias("std_line_qty"))
    return _long(a).unionByName(_long(b))


def _long(one_row: DataFrame) -> DataFrame:
    """A one-row frame of numbers as (Metric, Value) rows."""
    cols = one_row.columns
    return one_row.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
                  .unpivot([], cols, "Metric", "Value")


def relative_frequency(df: DataFrame, col: str, dimension: str) -> DataFrame:
    """Share of each non-null value; the total is a scalar subquery, not a global window."""
    nn = df.where(F.col(col).isNotNull())
    total = nn.select(F.count(F.lit(1))).scalar()
    return (nn.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(dimension).alias("Dimension"), F.col(col).cast("bigint").alias("Value"),
                      (F.col("n").cast("double") / total.cast("double")).alias("Share")))


def _floor1(c):
    return F.greatest(F.lit(1), F.floor(c).cast("bigint"))


def product_quantiles(lines: DataFrame) -> DataFrame:
    """Per product mean, floor(P10) and ceil(P90) of line quantity, each at least 1."""
    s = exact_percentiles(lines, ["ProductID"], "OrderQty", {"p10": "0.1", "p90": "0.9"}, mean="MeanQty")
    return s.select("ProductID", "MeanQty", _floor1(F.col("p10")).alias("P10"),
                    F.greatest(F.lit(1), F.ceil("p90").cast("bigint")).alias("P90"))


def global_quantiles(lines: DataFrame) -> DataFrame:
    """The same over all lines (mean floored at 1)."""
    s = exact_percentiles(lines, [], "OrderQty", {"p10": "0.1", "p90": "0.9"}, mean="m")
    return s.select(F.greatest(F.lit(1.0), _r(F.col("m"))).alias("MeanQty"), _floor1(F.col("p10")).alias("P10"),
                    F.greatest(F.lit(1), F.ceil("p90").cast("bigint")).alias("P90"))


def order_size_profile(lines: DataFrame) -> DataFrame:
    """Lines per order and units per order: mean, P10 (>=1), P90 (>= P10)."""
    per = lines.groupBy("SalesOrderID").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("OrderQty").alias("qty"))

    def trio(c, name):
        s = exact_percentiles(per, [], c, {"p10": "0.1", "p90": "0.9"}, mean="m")
        p10 = _floor1(F.col("p10"))
        return s.select(_r(F.col("m")).alias(f"{name}_mean"), p10.alias(f"{name}_p10"),
                        F.greatest(p10, F.ceil("p90").cast("bigint")).alias(f"{name}_p90"))

    q = trio("qty", "qty")
    qrow = q.select(F.struct(*q.columns).alias("q")).scalar()
    return trio("n_lines", "lines").select("*", *[qrow[c].alias(c) for c in q.columns])


def product_spread(lines: DataFrame) -> DataFrame:
    """Per-product mean and sample std (NULL/NaN -> 1), each floored at 1, then averaged."""
    per = lines.groupBy("ProductID").agg(F.avg("OrderQty").alias("m"), F.stddev_samp("OrderQty").alias("s"))
    s = F.when(F.col("s").isNull() | F.isnan("s"), F.lit(1.0)).otherwise(F.col("s"))
    return per.agg(_r(F.avg(F.greatest(F.lit(1.0), F.col("m")))).alias("product_mean_avg"),
                   _r(F.avg(F.greatest(F.lit(1.0), s))).alias("product_std_avg"))


def price_moments(price_history: DataFrame) -> DataFrame:
    """Mean and population std of current non-zero list prices; 100 / 50 when there are none."""
    cur = price_history.where(F.col("EndDate").isNull() & (F.col("ListPrice") > 0)) \
                       .select(F.col("ListPrice").cast("double").alias("p"))
    return cur.agg(F.coalesce(_r(F.avg("p")), F.lit(100.0)).alias("price_mean"),
                   F.coalesce(_r(F.stddev_pop("p")), F.lit(50.0)).alias("price_std"))


def quantity_cells(lines: DataFrame) -> DataFrame:
    """(ProductID, OrderQty, n): the lines as a histogram, at most one row a product and smallint quantity."""
    return lines.groupBy("ProductID", "OrderQty").agg(F.count(F.lit(1)).alias("n"))


def collect_samples(cells: DataFrame, key: str) -> DataFrame:
    """The quantity sample of each key, as sorted 'qty:count' pairs, from a histogram (key, OrderQty, n).

    Lossless for the multiset but bounded by the number of distinct quantities, so a key with a huge number
    of lines never builds a huge list. A key without quantities (a null one) has an empty sample.
    """
    pairs = cells.groupBy(key, "OrderQty").agg(F.sum("n").alias("n"))
    found = F.array_sort(F.collect_list(F.when(F.col("OrderQty").isNotNull(), F.struct("OrderQty", "n"))))
    return pairs.groupBy(key).agg(
        F.array_join(F.transform(found, lambda x: F.concat(x.OrderQty.cast("string"), F.lit(":"),
                                                           x.n.cast("string"))), ",").alias("QtySamples"))


def discount_tiers(offers: DataFrame) -> DataFrame:
    """(SpecialOfferID, TierMin, TierMax) of the discounted offers, MinQty floored at 1; a null TierMax is open."""
    lo = F.greatest(F.lit(1), F.col("MinQty"))
    return offers.where(F.col("UnitPriceDiscount") > 0).select(
        "SpecialOfferID", lo.alias("TierMin"),
        F.when(F.col("MaxQty").isNotNull(), F.greatest(lo, F.col("MaxQty"))).alias("TierMax"))


def tier_samples(cells: DataFrame, offers: DataFrame) -> DataFrame:
    """G17 by tier: (SpecialOfferID, QtySamples), empty tiers kept.

    The tiers' edges cut the quantity axis into segments (two a tier at most). A tier is a run of segments, a
    quantity lies in one of them, so tiers of any overlap meet the quantities in an equi-join on the segment,
    and the lines are not read again.
    """
    tiers = discount_tiers(offers)
    edges = F.array_sort(F.collect_set("e"))
    cut = (tiers.select(F.explode(F.array(F.col("TierMin"), F.col("TierMax") + 1)).alias("e")).where("e is not null")
           .select(edges.alias("edges")).scalar())

    def segment(q):
        return F.size(F.filter("__edges", lambda e: e <= q))
    known = F.coalesce(cut, F.array().cast("array<int>")).alias("__edges")
    of_tier = tiers.select("SpecialOfferID", "TierMin", "TierMax", known).select("SpecialOfferID", F.explode(F.sequence(
        segment(F.col("TierMin")), F.when(F.col("TierMax").isNull(), F.size("__edges")).otherwise(segment(F.col("TierMax")))))
        .alias("segment"))
    axis = (cells.groupBy("OrderQty").agg(F.sum("n").alias("n")).select("OrderQty", "n", known)
            .select("OrderQty", "n", segment(F.col("OrderQty")).alias("segment")))
    return collect_samples(of_tier.join(axis, "segment", "left"), "SpecialOfferID")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max of numeric columns (one row per column).

    Quartiles are exact (linear interpolation) and distributed: a value
    histogram ranked with a distributed running count, never one task holding
    every distinct value.
    """
    out = None
    for c in cols:
        x = F.col(c).cast("double")
        m = df.agg(F.count(x).alias("Count"), _r(F.avg(x)).alias("Mean"), _r(F.stddev_samp(x)).alias("Std"),
                   F.min(x).alias("Min"), F.max(x).alias("Max"))
        q = exact_percentiles(df.select(c), [], c, {"P25": "0.25", "P50": "0.5", "P75": "0.75"})
        qrow = q.select(F.struct(*[_r(F.col(k).cast("double")).alias(k) for k in ("P25", "P50", "P75")])).scalar()
        row = m.select(F.lit(c).alias("Measure"), "Count", "Mean", "Std", "Min", qrow["P25"].alias("P25"),
                       qrow["P50"].alias("P50"), qrow["P75"].alias("P75"), "Max")
        out = row if out is None else out.unionByName(row)
    return out


def profile_histogram(lines: DataFrame) -> DataFrame:
    """All that W18 asks of the lines, in one pass: four groupings of one scan and one shuffle.

    ``part`` cells: lines by (ProductID, OrderDate, OrderQty); orders: by (SalesOrderID, OrderDate); price and
    discount: by value. n counts lines, qty sums their quantity.
    """
    cols = ["ProductID", "OrderDate", "OrderQty", "SalesOrderID", "UnitPrice", "UnitPriceDiscount"]
    sets = {"cells": cols[:3], "orders": ["SalesOrderID", "OrderDate"], "price": ["UnitPrice"], "discount": ["UnitPriceDiscount"]}
    part = None
    for name, kept in sets.items():
        gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in kept)    # a set bit: not grouped by
        part = (F if part is None else part).when(F.grouping_id() == gid, name)
    return (lines.groupingSets([[F.col(c) for c in kept] for kept in sets.values()], *[F.col(c) for c in cols])
            .agg(part.alias("part"), F.count(F.lit(1)).alias("n"), F.sum("OrderQty").alias("qty")))


def _weighted(x: str, n: str = "n") -> dict:
    """Count, mean, population and sample deviation of column x with n rows a row; sums of integers are exact."""
    v, w = F.col(x).cast("decimal(20,4)") if x in ("UnitPrice", "UnitPriceDiscount") else F.col(x).cast("decimal(20,0)"), F.col(n)
    count = F.sum(w).cast("double")
    s1, s2 = F.sum((v * w).cast("double")), F.sum((v.cast("double") * v.cast("double")) * w)
    spread = F.greatest(s2 - s1 * s1 / count, F.lit(0.0))
    return {"count": count, "mean": s1 / count, "std_pop": F.sqrt(spread / count),
            "std_samp": F.sqrt(F.try_divide(spread, count - 1))}


def _keyed(df: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """(Metric, Key, Value): a row of df for each of the named columns."""
    rows = df.select(F.col(key).cast("string").alias("Key"), *[F.col(c).cast("double").alias(m) for m, c in values.items()])
    return rows.unpivot(["Key"], list(values), "Metric", "Value").select("Metric", "Key", "Value")


def _describe_weighted(hist: DataFrame, col: str) -> DataFrame:
    """G18 of one column from its histogram (col, n), as (Metric, Value)."""
    m = _weighted(col)
    a = hist.where(F.col(col).isNotNull()).agg(
        m["count"].alias("count"), _r(m["mean"]).alias("mean"), _r(m["std_samp"]).alias("std"),
        F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))
    q = exact_percentiles(hist, [], col, {"p25": "0.25", "p50": "0.5", "p75": "0.75"}, weight="n")
    q = q.select(*[_r(F.col(c).cast("double")).alias(c) for c in q.columns])
    both = _long(a).unionByName(_long(q))
    return both.select(F.concat(F.lit(f"describe_{col}_"), "Metric").alias("Metric"), "Value")


def history_profile(hist: DataFrame, header: DataFrame, price_history: DataFrame) -> DataFrame:
    """The demand profile as (Metric, Key, Value) rows; Key is null for statistics of all lines.

    ``hist`` is a written ``profile_histogram``: G9 (by date), G10, G11 (shares by product; by customer and
    salesperson from ``header``), G12 (by product), G13, G14, G15 and G18 come from it, not from the lines.
    """
    def part(name: str, *cols: str) -> DataFrame:
        return hist.where(F.col("part") == name).groupBy(*cols).agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"))
    orders = part("orders", "SalesOrderID", "OrderDate")
    daily = orders.groupBy("OrderDate").agg(F.sum("qty").alias("DailyQty"), F.count(F.lit(1)).alias("DailyOrders"))
    by_qty = part("cells", "OrderQty")
    cells = part("cells", "ProductID", "OrderQty")
    tenths = {"p10": "0.1", "p90": "0.9"}

    d = daily.agg(_r(F.avg("DailyQty")).alias("mean_daily_qty"), _r(F.stddev_pop("DailyQty")).alias("std_daily_qty"),
                  _r(F.avg("DailyOrders")).alias("mean_daily_orders"), _r(F.stddev_pop("DailyOrders")).alias("std_daily_orders"))
    m = _weighted("OrderQty")
    line = by_qty.agg(_r(m["mean"]).alias("mean_line_qty"), _r(m["std_pop"]).alias("std_line_qty"))
    g = exact_percentiles(by_qty, [], "OrderQty", tenths, mean="m", weight="n").select(
        F.greatest(F.lit(1.0), _r(F.col("m"))).alias("MeanQty"), _floor1(F.col("p10")).alias("P10"),
        F.greatest(F.lit(1), F.ceil("p90").cast("bigint")).alias("P90"))
    whole = [_long(d), _long(line), _long(g)]
    for col, name in (("n", "lines"), ("qty", "qty")):
        s = exact_percentiles(orders, [], col, tenths, mean="m")
        p10 = _floor1(F.col("p10"))
        whole.append(_long(s.select(_r(F.col("m")).alias(f"{name}_mean"), p10.alias(f"{name}_p10"),
                                    F.greatest(p10, F.ceil("p90").cast("bigint")).alias(f"{name}_p90"))))
    per = cells.groupBy("ProductID").agg(m["mean"].alias("m"), m["std_samp"].alias("s"))
    whole.append(_long(per.agg(_r(F.avg(F.greatest(F.lit(1.0), F.col("m")))).alias("product_mean_avg"),
                               _r(F.avg(F.greatest(F.lit(1.0), F.coalesce("s", F.lit(1.0))))).alias("product_std_avg"))))
    whole.append(_long(price_moments(price_history)))
    whole.append(_describe_weighted(by_qty, "OrderQty"))
    whole.append(_describe_weighted(part("price", "UnitPrice"), "UnitPrice"))
    whole.append(_describe_weighted(part("discount", "UnitPriceDiscount"), "UnitPriceDiscount"))
    out = _keyed(daily, "OrderDate", {"daily_qty": "DailyQty", "daily_orders": "DailyOrders"})
    for frame in whole:
        out = out.unionByName(frame.select("Metric", F.lit(None).cast("string").alias("Key"), "Value"))
    q = exact_percentiles(cells, ["ProductID"], "OrderQty", tenths, mean="m", weight="n")
    q = q.select("ProductID", _r(F.col("m")).alias("m"), _floor1(F.col("p10")).alias("p10"),
                 F.greatest(F.lit(1), F.ceil("p90").cast("bigint")).alias("p90"))
    out = out.unionByName(_keyed(q, "ProductID", {"product_mean_qty": "m", "product_p10": "p10", "product_p90": "p90"}))
    total = by_qty.select(F.sum("n")).scalar()
    shares = cells.groupBy("ProductID").agg((F.sum("n").cast("double") / total.cast("double")).alias("Share"))
    out = out.unionByName(_keyed(shares.select("ProductID", _r(F.col("Share"), 9).alias("x")), "ProductID", {"product_share": "x"}))
    for col, name in (("CustomerID", "customer"), ("SalesPersonID", "salesperson")):
        f = relative_frequency(header, col, name)
        out = out.unionByName(_keyed(f.select("Value", _r(F.col("Share"), 9).alias("x")), "Value", {f"{name}_share": "x"}))
    return out


# ---------------------------------------------------------------------------
# Offers
# ---------------------------------------------------------------------------

def offer_order(offers: DataFrame):
    """O2: the matching preference: MinQty desc, MaxQty asc (NULL last), discount desc."""
    return [F.col("MinQty").desc(), F.col("MaxQty").asc_nulls_last(), F.col("UnitPriceDiscount").desc(),
            F.col("SpecialOfferID").asc()]


def offer_for_quantities(quantities: DataFrame, offers: DataFrame, qty: str = "OrderQty") -> DataFrame:
    """J11 on the distinct quantities: the best matching offer, else the first zero-discount
    offer in preference order, else the last offer.

    Both inputs are small (distinct quantities of a smallint column; the offer
    table), so the range join and the ranking run on bounded data.
    """
    ranked_offers = offers.withColumn("__rank", F.row_number().over(Window.orderBy(*offer_order(offers))))
    fallback = ranked_offers.agg(
        F.coalesce(F.min_by(F.struct("SpecialOfferID", "UnitPriceDiscount"),
                            F.when(F.col("UnitPriceDiscount") == 0, F.col("__rank"))),
                   F.max_by(F.struct("SpecialOfferID", "UnitPriceDiscount"), F.col("__rank"))).alias("fb"))
    cond = (F.col("MinQty") <= F.col(qty)) & (F.col("MaxQty").isNull() | (F.col("MaxQty") >= F.col(qty)))
    matched = (quantities.join(F.broadcast(ranked_offers), cond, "left")
               .groupBy(qty).agg(F.min_by(F.struct("SpecialOfferID", "UnitPriceDiscount"), F.col("__rank"))
                                 .alias("best")))
    fb = fallback.select("fb").scalar()
    return matched.select(qty, F.coalesce(F.col("best"), fb).alias("o")) \
                  .select(qty, F.col("o.SpecialOfferID").alias("SpecialOfferID"),
                          F.col("o.UnitPriceDiscount").alias("UnitPriceDiscount"))


def assign_offers(lines: DataFrame, offers: DataFrame, qty: str = "OrderQty") -> DataFrame:
    """Every line gets its offer id and discount.

    The per-quantity lookup has at most one row per distinct quantity value (a
    bounded domain), so it is broadcast and the lines are never shuffled.
    """
    lookup = offer_for_quantities(lines.select(qty).distinct(), offers, qty)
    base = lines.drop("SpecialOfferID", "UnitPriceDiscount")
    return base.join(F.broadcast(lookup), qty, "left")


def tier_profile(lines: DataFrame, offers: DataFrame) -> DataFrame:
    """Per discounted tier (MinQty floored at 1), the number of history lines in range.

    Lines are first reduced to (quantity, count); empty tiers are kept.
    """
    counts = lines.groupBy(F.col("OrderQty").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    tiers = discount_tiers(offers)
    cond = (F.col("q") >= F.col("TierMin")) & (F.col("TierMax").isNull() | (F.col("q") <= F.col("TierMax")))
    return (F.broadcast(tiers).join(counts, cond, "left")
            .groupBy("SpecialOfferID", "TierMin", "TierMax")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("HistoryLines"))
            .withColumn("HasHistory", F.col("HistoryLines") > 0))
