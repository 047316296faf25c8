"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name (duplicates kept)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` (SQL EXCEPT); planned as a hash anti join on all columns."""
    return a.subtract(b)


def difference_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference (EXCEPT ALL), used by the round-trip check."""
    return a.exceptAll(b)
