"""Order-dependent operators over a *global* order that stay distributed.

A window with ORDER BY and no PARTITION BY runs in a single task. For
inputs that grow with the data (one row per customer or product) we instead:
sort (range-partitioned shuffle), number rows inside each partition,
checkpoint the result to the shared checkpoint folder (fixes partitioning,
cuts lineage, survives executor loss), and add the total size of all earlier
partitions -- a table with one row per partition, which is what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_ROW_BITS = 33                      # monotonically_increasing_id: partition id << 33 | row index
_ROW_MASK = (1 << _ROW_BITS) - 1


def _numbered(df: DataFrame, order_cols: list[Column]) -> DataFrame:
    s = df.orderBy(*order_cols).withColumn("__id", F.monotonically_increasing_id())
    return s.checkpoint(eager=True)


def _partition_offsets(numbered: DataFrame, value: str | None = None) -> DataFrame:
    pid = F.shiftright(F.col("__id"), _ROW_BITS).alias("__pid")
    aggs = [F.count(F.lit(1)).alias("__cnt")]
    if value is not None:
        aggs.append(F.sum(value).alias("__sum"))
    per = numbered.groupBy(pid).agg(*aggs)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col("__pid"), F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off")]
    if value is not None:
        cols.append(F.sum("__sum").over(before).alias("__sum_before"))
    return per.select(*cols)


def global_row_number(df: DataFrame, order_cols: list[Column], name: str = "rn") -> DataFrame:
    """Exact 1-based ROW_NUMBER() OVER (ORDER BY order_cols) without a single-partition window.

    ``order_cols`` must define a total order (add a unique tie-breaker).
    """
    n = _numbered(df, order_cols)
    offs = _partition_offsets(n)
    pid = F.shiftright(F.col("__id"), _ROW_BITS)
    return (n.join(F.broadcast(offs), pid == F.col("__pid"))
             .withColumn(name, F.col("__off") + F.col("__id").bitwiseAND(F.lit(_ROW_MASK)) + 1)
             .drop("__id", "__pid", "__off"))


def global_running_sum(df: DataFrame, order_cols: list[Column], value: str, name: str = "running") -> DataFrame:
    """Exact SUM(value) OVER (ORDER BY order_cols ROWS UNBOUNDED PRECEDING), distributed."""
    n = _numbered(df, order_cols)
    offs = _partition_offsets(n, value)
    pid = F.shiftright(F.col("__id"), _ROW_BITS)
    local = Window.partitionBy(pid).orderBy("__id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with_local = n.withColumn("__local", F.sum(value).over(local))
    out = with_local.join(F.broadcast(offs), pid == F.col("__pid"))
    return (out.withColumn(name, F.when(F.col("__sum_before").isNull(), F.col("__local"))
                                  .otherwise(F.col("__sum_before") + F.col("__local")))
               .drop("__id", "__pid", "__off", "__local", "__sum_before"))


def ntile_of(rank: Column, total: Column, buckets: int) -> Column:
    """NTILE(buckets) from an exact 1-based rank and the row count (first n % k buckets get one more)."""
    q = F.floor(total / buckets).cast("bigint")
    r = (total % buckets).cast("bigint")
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((rank - big - 1) / q) + 1).cast("int")


def global_ntile(df: DataFrame, order_cols: list[Column], buckets: int, name: str) -> DataFrame:
    """NTILE over a global order, computed from the distributed row number."""
    total = df.select(F.count(F.lit(1))).scalar()
    ranked = global_row_number(df, order_cols, "__rn")
    return ranked.withColumn(name, ntile_of(F.col("__rn"), total, buckets)).drop("__rn")
