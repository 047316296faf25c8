"""Mergeable distinct counts: sets of whole-number ids as bitmaps.

A set is one row for each group and each 32,768 neighbouring ids (``Bucket``), with a bit an id (``Bits``, 4 KiB).
Sets of parts of the data merge by OR, so a count over more data needs the bitmaps of what is new alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.functions.dates import month_start


def bitmaps(df: DataFrame, keys: list, id_col: str) -> DataFrame:
    """(keys, Bucket, Bits): the ids of each group. Null ids are in no set; partial aggregation keeps repeats off the shuffle."""
    return (df.where(F.col(id_col).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(id_col).alias("Bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("Bits")))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the sets that share their keys."""
    return parts.groupBy(*keys, "Bucket").agg(F.bitmap_or_agg("Bits").alias("Bits"))


def distinct_counts(parts: DataFrame, keys: list[str], name: str = "Distinct") -> DataFrame:
    """The number of different ids of each group, over all parts."""
    return merged(parts, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("Bits")).alias(name))


def month_customers(header: DataFrame) -> DataFrame:
    """(Month, Bucket, Bits): the customers with an order in each month."""
    return bitmaps(header.where("OrderDate is not null").select(month_start("OrderDate").alias("Month"), "CustomerID"),
                   ["Month"], "CustomerID")


def cohorts(months: DataFrame) -> DataFrame:
    """D8 from the bitmaps of months (``month_customers``, one row a month and bucket): no order is read.

    Seen(c) is the union of a bucket's months up to c. The customers of cohort c that are active in m are those in Seen(c)
    and m, less those in Seen(the bucket's month before c) and m. A bucket has one row a month, and a pair of months is
    one group of two bitmaps, so no group grows with the customers.
    """
    bucket = Window.partitionBy("Bucket").orderBy("Month")
    seen = months.select(F.col("Bucket").alias("b"), F.col("Month").alias("Cohort"), F.bitmap_or_agg("Bits").over(bucket).alias("Seen"))
    pairs = seen.join(months, (F.col("b") == F.col("Bucket")) & (F.col("Cohort") <= F.col("Month")))
    both = (pairs.select("Bucket", "Cohort", "Month", F.explode(F.array("Seen", "Bits")).alias("Bits"))
                 .groupBy("Bucket", "Cohort", "Month").agg(F.bitmap_count(F.bitmap_and_agg("Bits")).alias("n")))
    earlier = F.coalesce(F.lag("n").over(Window.partitionBy("Bucket", "Month").orderBy("Cohort")), F.lit(0))
    active = both.withColumn("new", F.col("n") - earlier).groupBy("Cohort", "Month").agg(F.sum("new").alias("ActiveCustomers")) \
                 .where("ActiveCustomers > 0")
    size = active.where("Month = Cohort").select("Cohort", F.col("ActiveCustomers").alias("CohortSize"))
    offset = ((F.year("Month") - F.year("Cohort")) * 12 + F.month("Month") - F.month("Cohort"))
    return active.join(size, "Cohort").select(
        F.col("Cohort").alias("CohortMonth"), offset.alias("MonthOffset"), "ActiveCustomers", "CohortSize",
        (F.col("ActiveCustomers").cast("double") / F.col("CohortSize")).alias("RetentionRate"))
