"""S5/S2 for tables in folders by a column's value: a part is replaced without touching the others.

The replaced folders are written beside the table and moved in when all tasks are done, so a lost executor costs a
task, not the table. The move itself is one rename a folder: a driver lost during it can leave a folder out, and the
same call repairs that. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _dealt(df: DataFrame, by: str, rebalance: bool) -> DataFrame:
    return df.hint("rebalance", by) if rebalance else df


def write_partitioned(df: DataFrame, path: str, by: str, rebalance: bool = True) -> str:
    """A new table at ``path`` with one folder for each value of ``by``. Rows are rebalanced by that column first: few files
    a folder, and a value with very many rows is dealt to several tasks. Without ``rebalance`` no row is shuffled for it
    and each task writes a file for each of its values: for few values and rows that a join has dealt already."""
    _dealt(df, by, rebalance).write.mode("errorifexists").partitionBy(by).parquet(path)
    return path


def replace_parts(df: DataFrame, path: str, by: str, rebalance: bool = True) -> str:
    """S5 for a part: the folders of the values of ``by`` in df are replaced by its rows, all others stay as they are.

    A value that df has no row of keeps its folder. df may read the table itself: the old files go after the new ones
    are written.
    """
    _dealt(df, by, rebalance).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return path


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table with its declared schema (``by`` included); filters and joins on ``by`` prune folders."""
    return spark.read.schema(schema).parquet(path)


def by_year(df: DataFrame, date: str | Column = "OrderDate", name: str = "OrderYear") -> DataFrame:
    """df with the year it is stored under; rows without a date are stored under no year."""
    return df.withColumn(name, F.year(date))
