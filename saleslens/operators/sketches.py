"""Quantiles kept up to date: sketches (KLL) of parts of the data, stored and merged.

A sketch holds some values of its part, with weights, in bounded memory; sketches of parts merge to one of the whole. So
a new part adds its own sketches, and quantiles are asked of the merged ones without reading the data again. They are
approximate in rank: a quantile's value has a rank that is off by at most ``rank_error`` of all rows (with 99 %
certainty each). A sketch of at most K rows, merged ones included, holds them all and is exact. Counts and sums beside
the sketches are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values kept on a sketch's largest level; more means a smaller error and a larger sketch.
K = 800


def rank_error(k: int = K) -> float:
    """The error in rank, as a share of the rows, that a sketch of parameter k keeps with 99 % certainty (as published
    for the sketch: 2.296 / k^0.9723)."""
    return 2.296 / k ** 0.9723


def sketch(value: Column) -> Column:
    """The sketch of a group's whole numbers; nulls are in none."""
    return F.kll_sketch_agg_bigint(value.cast("bigint"), K)


def merged(sketches: str) -> Column:
    """The sketch of all rows of a group's sketches."""
    return F.kll_merge_agg_bigint(sketches, K)


def quantile(merged_sketch: str, p: float) -> Column:
    """The least value whose rank is at least the share p, within the error; null for a sketch of no value."""
    return F.when(F.kll_sketch_get_n_bigint(merged_sketch) > 0, F.kll_sketch_get_quantile_bigint(merged_sketch, F.lit(p)))


def product_days(lines: DataFrame) -> DataFrame:
    """(OrderDate, ProductID, Lines, Units, QtySketch) of the lines with a quantity: one row a day and product."""
    return lines.where("OrderQty is not null").groupBy("OrderDate", "ProductID").agg(
        F.count(F.lit(1)).alias("Lines"), F.sum("OrderQty").alias("Units"), sketch(F.col("OrderQty")).alias("QtySketch"))


def order_days(lines: DataFrame) -> DataFrame:
    """(OrderDate, Orders, Lines, Units, LinesSketch, UnitsSketch) over the orders of each day. An order has one day."""
    per = lines.groupBy("OrderDate", "SalesOrderID").agg(F.count(F.lit(1)).alias("n"), F.sum("OrderQty").alias("q"))
    return per.groupBy("OrderDate").agg(F.count(F.lit(1)).alias("Orders"), F.sum("n").alias("Lines"), F.sum("q").alias("Units"),
                                        sketch(F.col("n")).alias("LinesSketch"), sketch(F.col("q")).alias("UnitsSketch"))


def _at_least_one(c: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), c)


def product_quantiles(days: DataFrame) -> DataFrame:
    """G12 from ``product_days``: the exact mean, P10 and P90 (at least 1, no interpolation) of each product."""
    whole = days.groupBy("ProductID").agg(F.sum("Lines").alias("Lines"), F.sum("Units").alias("Units"), merged("QtySketch").alias("s"))
    return whole.select("ProductID", "Lines", (F.col("Units").cast("double") / F.col("Lines")).alias("MeanQty"),
                        _at_least_one(quantile("s", 0.1)).alias("P10"), _at_least_one(quantile("s", 0.9)).alias("P90"))


def global_quantiles(days: DataFrame) -> DataFrame:
    """G13 from ``product_days``: the same over all lines, the mean at least 1. No rows without lines."""
    whole = days.agg(F.sum("Lines").alias("Lines"), F.sum("Units").alias("Units"), merged("QtySketch").alias("s")).where("Lines > 0")
    return whole.select("Lines", F.greatest(F.lit(1.0), F.round(F.col("Units").cast("double") / F.col("Lines"), 6)).alias("MeanQty"),
                        _at_least_one(quantile("s", 0.1)).alias("P10"), _at_least_one(quantile("s", 0.9)).alias("P90"))


def order_size_profile(days: DataFrame) -> DataFrame:
    """G14 from ``order_days``: lines and units an order: exact mean, P10 (at least 1) and P90 (at least P10).
    The mean of the units is null if no order has any."""
    whole = days.agg(F.sum("Orders").alias("o"), F.sum("Lines").alias("l"), F.sum("Units").alias("u"),
                     merged("LinesSketch").alias("ls"), merged("UnitsSketch").alias("us")).where("o > 0")
    out = []
    for name, total, s in (("lines", "l", "ls"), ("qty", "u", "us")):
        low = _at_least_one(quantile(s, 0.1))
        out += [F.round(F.col(total).cast("double") / F.col("o"), 6).alias(f"{name}_mean"), low.alias(f"{name}_p10"),
                F.greatest(low, quantile(s, 0.9)).alias(f"{name}_p90")]
    return whole.select(F.col("o").alias("Orders"), *out)
