"""Join operators the pipeline needs beyond a plain equi-join.

Broadcast policy: a side is hinted for broadcast only when its row count is
bounded by a fixed domain (offer tiers, categories, one-row scalars) or when
its size was measured just before (``small_side``: the large side is then not
shuffled at all). Every other join is left to the planner; with AQE on, a side whose *measured*
shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is
broadcast at runtime and anything larger stays a sort-merge join, whose skewed
partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a side may take in an executor's memory as a hash relation, by the estimate of ``relation_bytes``.
BROADCAST_BYTES = 64 << 20
_TEXT = (T.StringType, T.BinaryType)


def relation_bytes(df: DataFrame) -> int | None:
    """An upper estimate of df as a hash relation: its rows are counted and its texts measured in one aggregate. None
    if a column has another type whose size isn't known from its type (arrays, maps, structs)."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, _TEXT)]
    if any(not isinstance(f.dataType, (*_TEXT, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
           for f in df.schema):
        return None
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).alias(f"b{i}")
                                                 for i, c in enumerate(texts)]).first()
    # A row: its words (two a decimal) and null bits, a copy of the key, the map's slots.
    words = sum(3 if isinstance(f.dataType, T.DecimalType) else 1 for f in df.schema)
    return row["n"] * (64 + 8 * words) + 2 * sum(row[1:])


def small_side(df: DataFrame) -> DataFrame:
    """df, hinted for broadcast if its measured size is at most ``BROADCAST_BYTES``; otherwise as it is, for a shuffled join.

    Runs one aggregate over df, so df should be a dimension, not the large side. Select the joined columns first.
    """
    size = relation_bytes(df)
    return F.broadcast(df) if size is not None and size <= BROADCAST_BYTES else df


def interval_join(left: DataFrame, right: DataFrame, key: str, point: str,
                  start: str = "StartDate", end: str = "EndDate", how: str = "inner",
                  right_cols: list[str] | None = None) -> DataFrame:
    """As-of join of ``left.point`` into closed ``[start, end]`` intervals of ``right``.

    A NULL ``end`` means the interval is still open. The equality on ``key``
    lets Spark hash-partition (or broadcast) on it; the range is a residual
    condition evaluated inside the join, so no pair outside the key is formed.
    Pass ``small_side`` of the intervals if they may be small: then ``left`` isn't shuffled.
    Overlapping intervals duplicate a left row and uncovered rows vanish
    (inner) -- exactly as in the reference; see dq_cost_coverage / dq_interval_overlap.
    """
    r = right.select(F.col(key).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e"),
                     *[F.col(c) for c in (right_cols or [])])
    p = F.col(point)
    cond = (F.col(key) == F.col("__k")) & (p >= F.col("__s")) & (F.col("__e").isNull() | (p <= F.col("__e")))
    return left.join(r, cond, how).drop("__k", "__s", "__e")


#: A key with at least this part of all rows is hot; there are at most so many of them.
HOT = 4096
NO_BUCKET = "0001-01-01"


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(key) of the keys that hold at least 1 / HOT of the rows of df: at most HOT keys at any input."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.where(F.col("__n") * HOT >= total).select(key)


def bucketed_interval_join(left: DataFrame, right: DataFrame, key: str, point: str, hot: DataFrame, since: Column,
                           until: Column, start: str = "StartDate", end: str = "EndDate",
                           right_cols: list[str] | None = None, unit: str = "MONTH") -> DataFrame:
    """``interval_join`` (inner) whose hot keys are dealt by time as well, so that no key is one task.

    A row of a hot key meets only intervals of its own ``unit`` (DAY, WEEK, MONTH, QUARTER, YEAR): both sides are joined
    on (key, bucket), then on the exact bounds. Intervals of hot keys stand once in each bucket that they
    touch between ``since`` and ``until``, which must enclose all points; other keys have one bucket, so
    nothing else grows. A point has one bucket, so no row is found twice. ``hot`` (key) is broadcast; it has
    at most HOT rows (``hot_keys``).
    """
    def floor(c: Column) -> Column:
        return F.date_trunc(unit, c).cast("date")
    none = F.lit(NO_BUCKET).cast("date")
    flags = F.broadcast(hot.select(F.col(key).alias("__hot")).distinct())
    p = F.col(point)
    rows = left.join(flags, F.col(key) == F.col("__hot"), "left").withColumn(
        "__b", F.when(F.col("__hot").isNotNull(), floor(p)).otherwise(none)).drop("__hot")
    r = right.select(F.col(key).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e"),
                     *[F.col(c) for c in (right_cols or [])])
    lo, hi = F.greatest(F.col("__s"), since), F.least(F.coalesce(F.col("__e"), until), until)
    step = F.expr(f"INTERVAL 1 {unit}" if unit != "QUARTER" else "INTERVAL 3 MONTH")
    buckets = F.when(F.col("__hot").isNull(), F.array(none)).when(lo <= hi, F.sequence(floor(lo), floor(hi), step))
    intervals = r.join(flags, F.col("__k") == F.col("__hot"), "left").withColumn("__rb", F.explode(buckets)).drop("__hot")
    cond = ((F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__rb")) & (p >= F.col("__s"))
            & (F.col("__e").isNull() | (p <= F.col("__e"))))
    return rows.join(intervals, cond).drop("__k", "__s", "__e", "__b", "__rb")


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame whose size is fixed by a small domain (not by data volume)."""
    return F.broadcast(df)


def range_match(left: DataFrame, tiers: DataFrame, qty: str, lo: str = "MinQty", hi: str = "MaxQty",
                how: str = "inner") -> DataFrame:
    """Quantity-range join: ``lo <= qty <= hi`` with NULL ``hi`` = no cap.

    ``tiers`` is an offer table (a handful of rows), broadcast so the large
    side is never shuffled; the join is a BroadcastNestedLoop over a bounded
    build side, i.e. a streaming filter per large-side row.
    """
    cond = (F.col(lo) <= F.col(qty)) & (F.col(hi).isNull() | (F.col(hi) >= F.col(qty)))
    return left.join(bounded_broadcast(tiers), cond, how)


def semi(left: DataFrame, right: DataFrame, on, anti: bool = False) -> DataFrame:
    """J7/J8 (EXISTS) and J9/J10/J14 (NOT EXISTS) as left-semi / left-anti joins."""
    return left.join(right, on, "left_anti" if anti else "left_semi")


def keys_of(df: DataFrame, cols) -> DataFrame:
    cols = [cols] if isinstance(cols, (str, Column)) else cols
    return df.select(*cols)
