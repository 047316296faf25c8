"""Aggregates Spark does not ship in the exact form the pipeline needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T


def _decimal_lit(p: str) -> Column:
    scale = len(p.split(".")[1]) if "." in p else 0
    return F.lit(p).cast(f"decimal({max(len(p.replace('.', '').lstrip('-')), scale + 1)},{scale})")


def _value_type(df: DataFrame, col: str) -> str:
    t = df.schema[col].dataType
    if isinstance(t, T.DecimalType):
        return f"decimal(38,{t.scale})"
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "decimal(20,0)"
    return "double"


def exact_percentiles(df: DataFrame, keys: list[str], col: str, ps: dict[str, str],
                      mean: str | None = None, weight: str | None = None) -> DataFrame:
    """Linear-interpolation percentiles (the NumPy default) computed exactly.

    ``ps`` maps an output name to a percentile fraction given as decimal text
    ("0.1", "0.9"). The position ``(n-1)·p`` and, for integer and decimal
    values, the interpolation are evaluated in decimal arithmetic, so floor/ceil
    of the result never suffer from binary rounding (Spark's ``percentile`` and
    other engines interpolate in double).

    Plan: values are first reduced to a (key, value, count) histogram with
    map-side partial aggregation, so a key holding a large share of the rows
    never brings those rows together. With grouping keys, a window per key
    over the histogram gives each value's rank range (its size is the number
    of distinct values of that key: small for quantities, counts and day gaps).
    Without keys, the histogram of the whole column is ranked with the
    distributed running sum instead of a single-partition window, unless the
    column's type bounds it (tinyint / smallint: at most 65,536 rows). One more
    aggregate picks the two neighbouring values. ``mean`` adds the exact mean. With ``weight`` a row stands
    for that many rows, so df may be a histogram already.
    """
    vt = _value_type(df, col)
    hist = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("__v")) \
             .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__c"))
    small_domain = isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType))   # <= 65,536 distinct values
    if keys or small_domain:
        wk = Window.partitionBy(*keys)
        wo = wk.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        h = hist.select(*keys, "__v", "__c", (F.sum("__c").over(wo) - F.col("__c")).alias("__start"),
                        F.sum("__c").over(wk).alias("__n"))
    else:
        from saleslens.operators.windows import global_running_sum
        n = hist.select(F.sum("__c")).scalar()
        run = global_running_sum(hist, [F.col("__v")], "__c", "__cum")
        h = run.select("__v", "__c", (F.col("__cum") - F.col("__c")).alias("__start"), n.alias("__n"))
    aggs = []
    for name, p in ps.items():
        pos = (F.col("__n") - 1).cast("decimal(20,0)") * _decimal_lit(p)
        lo, hi = F.floor(pos), F.ceil(pos)
        end = F.col("__start") + F.col("__c")
        aggs += [F.max(F.when((F.col("__start") <= lo) & (lo < end), F.col("__v"))).alias(f"__lo_{name}"),
                 F.max(F.when((F.col("__start") <= hi) & (hi < end), F.col("__v"))).alias(f"__hi_{name}"),
                 F.max(pos - lo).alias(f"__f_{name}")]
    if mean:
        aggs.append((F.sum(F.col("__v") * F.col("__c")).cast("double") / F.sum("__c")).alias(mean))
    picked = h.groupBy(*keys).agg(*aggs)
    outs = []
    for name in ps:
        vlo = F.col(f"__lo_{name}").cast(vt)
        vhi = F.col(f"__hi_{name}").cast(vt)
        frac = F.col(f"__f_{name}")
        if vt == "double":
            frac = frac.cast("double")
        outs.append((vlo + frac * (vhi - vlo)).alias(name))
    return picked.select(*keys, *([mean] if mean else []), *outs)
