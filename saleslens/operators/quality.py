"""Data-quality checks (Q1-Q13): each returns a DataFrame of violations (empty = pass).

The reference enforced these as table constraints or aborted inline; here they
are distributed jobs. ``fail_on_violation`` turns any of them into a guard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    pass


def fail_on_violation(violations: DataFrame, name: str) -> None:
    """Raise when the check found anything; only one row is ever fetched."""
    if violations.limit(1).count() > 0:
        raise QualityError(f"data-quality check failed: {name}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def tagged_duplicates(checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Duplicate report over several tables: (TableName, KeyValue, n)."""
    out = None
    for name, df, key in checks:
        d = duplicate_keys(df.select(F.col(key).cast("bigint").alias("KeyValue")), ["KeyValue"]) \
            .select(F.lit(name).alias("TableName"), "KeyValue", "n")
        out = d if out is None else out.unionByName(d)
    return out


def null_columns(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Q2: (key, ColumnName) for every required column that is NULL; one pass over the table."""
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return (df.select(F.col(key), F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("ColumnName")))


def keys_present(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Q4: batch keys that already exist in the history (left semi join)."""
    return batch.select(key).join(history.select(key), key, "left_semi")


def dates_expected(batch: DataFrame, history: DataFrame, col: str = "OrderDate") -> DataFrame:
    """Q5: one row when the batch dates are not all equal to the day after the history's last date."""
    expected = F.date_add(history.select(F.max(col)).scalar(), 1)
    return (batch.agg(F.min(col).alias("MinDate"), F.max(col).alias("MaxDate"))
            .select("MinDate", "MaxDate", expected.alias("ExpectedDate"))
            .where((F.col("MinDate") != F.col("ExpectedDate")) | (F.col("MaxDate") != F.col("ExpectedDate"))))


def ids_after_max(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Q6: one row when the smallest new id is not above the largest old id."""
    max_old = history.select(F.max(key)).scalar()
    return (batch.agg(F.min(key).alias("MinNewID")).select("MinNewID", max_old.alias("MaxOldID"))
            .where(F.col("MinNewID") <= F.col("MaxOldID")))


def missing_in(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Q7 / Q12: child rows whose non-NULL key has no parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def orphan_keys(counts: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Q12: of a child's keys with their row counts (child_key, n; see key_counts) those without a parent. Rows are summed by key
    before any shuffle, so the join sorts keys, not rows, and a key of very many rows is one row of each task."""
    p = parent.select(F.col(parent_key).alias("__pk"))
    return counts.join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def key_counts(child: DataFrame, key: str) -> DataFrame:
    """(key, n): the non-NULL values of a column and their rows."""
    return child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def uncovered_by_intervals(lines: DataFrame, history: DataFrame, key: str, point: str,
                           start: str = "StartDate", end: str = "EndDate") -> DataFrame:
    """Q9: lines with no interval of their key containing their date (what an inner as-of join drops)."""
    h = history.select(F.col(key).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e"))
    p = F.col(point)
    cond = (F.col(key) == F.col("__k")) & (p >= F.col("__s")) & (F.col("__e").isNull() | (p <= F.col("__e")))
    return lines.join(h, cond, "left_anti")


def overlapping_intervals(history: DataFrame, key: str = "ProductID", start: str = "StartDate",
                          end: str = "EndDate") -> DataFrame:
    """Q10: intervals that start on or before the latest end of the earlier intervals of their key.

    Earlier means a smaller (start, end); an open end counts as 9999-12-31. The running maximum also
    finds an interval nested in one that is not its direct predecessor. The window streams over rows
    sorted by key and start: a key with many intervals spills, it is not held as a list.
    """
    w = (Window.partitionBy(key).orderBy(F.col(start), F.col(end).asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, -1))
    ends = F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))
    return (history.select(key, start, end).withColumn("EarlierEnd", F.max(ends).over(w))
            .where(F.col(start) <= F.col("EarlierEnd")))


def emptiness(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """Q13: (TableName, IsEmpty) per input; each reads at most one row."""
    out = None
    for name, df in frames:
        r = df.limit(1).agg((F.count(F.lit(1)) == 0).alias("IsEmpty")).select(F.lit(name).alias("TableName"),
                                                                              "IsEmpty")
        out = r if out is None else out.unionByName(r)
    return out


def price_positive(lines: DataFrame, price_history: DataFrame) -> DataFrame:
    """Q8: (ProductID, ListPrice) of the lines' products without a current list price above 0."""
    cur = price_history.where(F.col("EndDate").isNull()).select("ProductID", "ListPrice")
    return (lines.select("ProductID").distinct().join(cur, "ProductID", "left")
            .where(F.col("ListPrice").isNull() | (F.col("ListPrice") <= 0)))


def online_with_salesperson(header: DataFrame) -> DataFrame:
    """Q11: (SalesOrderID, SalesPersonID) of online orders that have a salesperson."""
    return header.where(F.col("OnlineOrderFlag") & F.col("SalesPersonID").isNotNull()).select("SalesOrderID", "SalesPersonID")
