"""Limits of quantiles and shares without sorting: where a running sum over an order passes given amounts.

A pass over the rows sums their weights into ``BINS`` equal bins between the least and the largest key; the bin in which
the running sum passes an amount holds the limit, and the next pass cuts that bin alone, down to one (key, tie). The
order itself is never made: a row's class is the number of limits it reaches, which is one comparison a limit.

A pass shuffles at most BINS sums a limit and task, and one row comes back to the driver. Integer keys of b bits and ties
of t bits take at most b / 16 + t / 16 passes, rounded up each, whatever the values' distribution; all limits of all
orders go through them together.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BINS = 1 << 16
_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Order:
    """Rows by key, then tie, ascending, and the amounts whose limits are asked for.

    Both columns hold whole numbers (of any whole type). For a descending order negate them.
    """
    key: Column
    tie: Column
    amounts: tuple


@dataclass(frozen=True)
class _Bracket:
    """The (key, tie) ranges that still hold a limit; below: the weight of all rows before them."""
    order: int
    amount: object
    lo: int
    hi: int
    tie_lo: int
    tie_hi: int
    below: object

    @property
    def place(self) -> tuple:
        return self.order, self.lo, self.hi, self.tie_lo, self.tie_hi

    @property
    def done(self) -> bool:
        return self.lo == self.hi and self.tie_lo == self.tie_hi


def _whole(v: int) -> Column:
    return F.lit(str(v)).cast(_WHOLE)


def limits(df: DataFrame, orders: list[Order], weight: Column | None = None) -> list[list[tuple[int, int] | None]]:
    """For each order and each of its amounts the first (key, tie) at which the running sum of weight (of rows, if None)
    is above the amount; None if it never is. Rows with a null key or tie are left out.

    Rows that agree in key and tie stand at one place: their weights are added at once. Running sums must not fall
    back to an amount once they passed it, as with weights that aren't negative. An empty table has no limits. df is read once
    a pass, so it should be a written or checkpointed table.
    """
    w = (F.lit(1) if weight is None else weight).alias("w")
    rows = df.select(w, *[c.cast(_WHOLE).alias(f"{n}{i}") for i, o in enumerate(orders) for n, c in (("k", o.key), ("t", o.tie))])
    spans = rows.agg(*[f(F.when(F.col(f"k{i}").isNotNull() & F.col(f"t{i}").isNotNull(), F.col(f"{n}{i}"))).alias(f"{n}{i}{name}")
                       for i in range(len(orders)) for n in "kt" for name, f in (("min", F.min), ("max", F.max))]).first()
    found: list[list] = [[None] * len(o.amounts) for o in orders]
    open_ = {}
    for i, o in enumerate(orders):
        if spans[f"k{i}min"] is not None:
            for j, a in enumerate(o.amounts):
                open_[i, j] = _Bracket(i, a, int(spans[f"k{i}min"]), int(spans[f"k{i}max"]),
                                       int(spans[f"t{i}min"]), int(spans[f"t{i}max"]), 0)
    while open_:
        open_ = _narrowed(rows, open_)
        for (i, j), b in list(open_.items()):
            if b.done:
                found[i][j] = (b.lo, b.tie_lo)
                del open_[i, j]
    return found


def _narrowed(rows: DataFrame, open_: dict) -> dict:
    """One pass: each bracket is cut to its bin; those without a limit go."""
    places = sorted({b.place for b in open_.values()})
    cells = []
    for i in sorted({p[0] for p in places}):
        k, t = F.col(f"k{i}"), F.col(f"t{i}")
        cell = None
        for n, p in enumerate(places):
            if p[0] != i:
                continue
            _, lo, hi, tie_lo, tie_hi = p
            by, first, last, inside = (k, lo, hi, k.between(_whole(lo), _whole(hi))) if lo < hi else (
                t, tie_lo, tie_hi, (k == _whole(lo)) & t.between(_whole(tie_lo), _whole(tie_hi)))
            width = (last - first) // BINS + 1
            number = F.call_function("div", by - _whole(first), _whole(width)).cast("int")
            value = F.struct(F.lit(n).alias("place"), number.alias("bin"), k.alias("k"), t.alias("t"))
            cell = (F if cell is None else cell).when(inside & t.isNotNull(), value)
        cells.append(cell)
    summed = (rows.select("w", F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).select("w", "c.*")
              .groupBy("place", "bin").agg(F.sum("w").alias("w"), F.min("k").alias("lo"), F.max("k").alias("hi"),
                                           F.min("t").alias("tie_lo"), F.max("t").alias("tie_hi")))
    # At most BINS rows a place in the window.
    running = summed.withColumn("sum", F.sum("w").over(Window.partitionBy("place").orderBy("bin")))
    passed = []
    for n, b in enumerate(open_.values()):
        above = (F.col("place") == places.index(b.place)) & (F.col("sum") > F.lit(b.amount - b.below))
        passed.append(F.min(F.when(above, F.struct("bin", "lo", "hi", "tie_lo", "tie_hi", (F.col("sum") - F.col("w")).alias("before")))).alias(f"b{n}"))
    row = running.agg(*passed).first()
    out = {}
    for n, (at, b) in enumerate(open_.items()):
        x = row[f"b{n}"]
        if x is not None:
            out[at] = replace(b, lo=int(x["lo"]), hi=int(x["hi"]), tie_lo=int(x["tie_lo"]), tie_hi=int(x["tie_hi"]), below=b.below + x["before"])
    return out


def reached(order: Order, found: list[tuple[int, int] | None]) -> Column:
    """How many of the order's limits (of ``limits``) a row reaches; one with a null key or tie reaches none."""
    k, t = order.key.cast(_WHOLE), order.tie.cast(_WHOLE)
    out = F.lit(0)
    for limit in found:
        if limit is not None:
            at = (k > _whole(limit[0])) | ((k == _whole(limit[0])) & (t >= _whole(limit[1])))
            out = out + F.when(at, 1).otherwise(0)
    return out


def tile_ends(rows: int, tiles: int) -> tuple[int, ...]:
    """The ranks at which the first tiles - 1 of NTILE(tiles) end: the first rows % tiles of them have one row more."""
    size, more = divmod(rows, tiles)
    return tuple(size * i + min(i, more) for i in range(1, tiles))


def tiles(df: DataFrame, orders: dict[str, tuple[Column, Column]], n: int) -> DataFrame:
    """df with a column NTILE(n) for each (key, tie) order of ``orders``, all from the same passes.

    Keys and ties are whole numbers; ties should tell rows with equal keys apart (rows that agree in both share the
    tile of the last of them). Null keys, and null ties of equal keys, come last.
    """
    cols = [c.cast(_WHOLE) for pair in orders.values() for c in pair]
    first = df.agg(F.count(F.lit(1)), *[F.max(c) for c in cols]).first()
    rows, most = first[0], [0 if m is None else int(m) for m in first[1:]]
    filled = [F.coalesce(c, _whole(m + 1)) for c, m in zip(cols, most)]
    asked = {name: Order(filled[2 * i], filled[2 * i + 1], tile_ends(rows, n)) for i, name in enumerate(orders)}
    found = limits(df, list(asked.values()))
    return df.select("*", *[(reached(o, f) + 1).cast("int").alias(name) for (name, o), f in zip(asked.items(), found)])
