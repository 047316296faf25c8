"""Embedding near-dedup by collision-counting projections.

Vectors of length one are projected on ``PROJECTIONS`` random lines. Two vectors with the least cosine c to be
linked are at distance d = sqrt(2 - 2c), and on any of the lines their difference is normal with deviation d.
So each collides with the other in a query-centred window of half-width d with a known probability, and the
number of collisions over the lines is binomial; a pair goes on if it has at least the count that a pair
at c reaches with probability ``RECALL`` (closer pairs reach it more surely). Pairs that go on are checked
by their cosine in double precision.

So that a pair meets in one task only where it can collide at all, the first lines are sorted and cut at their
medians: a vector is stored in one cell and asked for in every cell that its window reaches. More vectors mean more
cuts and wider windows: what the count leaves of 1 - ``RECALL`` is the chance that any of the cuts parts a pair at c,
so a pair is found with RECALL at every size. Cells of more than ``BLOCK`` vectors are dealt in blocks. The line after the
cuts orders a task's vectors: a query asks only those above it, as far as its window there reaches, so each pair is asked
for once. In a task the windows are slices of the sorted projections, and collisions are counted for 64 vectors at a
time, as bit planes. A task sends back how many links each vector has and a forest of them, not the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import prepare, written
from saleslens.llm.components import components
from saleslens.llm.simhash import forest

PROJECTIONS, RECALL, SEED = 32, 0.999, 17
#: Vectors of a cell that one task compares queries with.
BLOCK = 4096


def lines(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((dim, PROJECTIONS))


def reached(width: float, count: int) -> float:
    """The chance that a pair at the least cosine has so many collisions; width in deviations."""
    p = math.erf(width / math.sqrt(2))
    return sum(math.comb(PROJECTIONS, k) * p ** k * (1 - p) ** (PROJECTIONS - k) for k in range(count, PROJECTIONS + 1))


def cut_count(n: int) -> int:
    """Median cuts for n vectors."""
    return max(0, min(PROJECTIONS - 1, math.ceil(math.log2(max(1, n / BLOCK)))))


def reach_of(cuts: int) -> float:
    """Half-width of the cells' windows, in deviations of a pair at the least cosine: all cuts together lose what the count leaves
    of 1 - RECALL, at most."""
    lost = (reached(1.0, least_count(1.0)) - RECALL) / max(1, cuts)
    return NormalDist().inv_cdf(1 - lost / 2)


def least_count(width: float) -> int:
    """The largest count that a pair at the least cosine reaches with probability RECALL; width in deviations."""
    return next((k for k in range(PROJECTIONS, -1, -1) if reached(width, k) >= RECALL), 0)


def _unit(values) -> np.ndarray | None:
    """The vector divided by its length; None if it links with nothing."""
    if values is None:
        return None
    v = np.array([np.nan if x is None else x for x in values], np.float64) if getattr(values, "dtype", None) in (None, object) else np.asarray(values, np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    v = v / (np.abs(v).max() or 1.0)
    n = np.sqrt(v @ v)
    return v / n if n > 0 and np.isfinite(n) else None


def _window_bits(sorted_p: np.ndarray, order: np.ndarray, q: np.ndarray, width: float) -> np.ndarray:
    """For each query, a bit for each stored vector whose projection lies in its window."""
    n = len(order)
    words = -(-n // 64)
    prefix = np.zeros((n + 1, words), np.uint64)
    prefix[np.arange(1, n + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
    np.bitwise_or.accumulate(prefix, axis=0, out=prefix)
    return prefix[np.searchsorted(sorted_p, q + width, "right")] ^ prefix[np.searchsorted(sorted_p, q - width, "left")]


def _colliding(pq: np.ndarray, pd_: np.ndarray, width: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, stored) pairs with at least ``least`` collisions over the lines, counted in bit planes."""
    n_planes = PROJECTIONS.bit_length()
    words = -(-len(pd_) // 64)
    planes = np.zeros((n_planes, len(pq), words), np.uint64)
    for j in range(PROJECTIONS):
        order = np.argsort(pd_[:, j], kind="stable")
        carry = _window_bits(pd_[order, j], order, pq[:, j], width)
        for k in range(min(n_planes, (j + 1).bit_length())):
            planes[k], carry = planes[k] ^ carry, planes[k] & carry
    above, equal = np.zeros((len(pq), words), np.uint64), np.full((len(pq), words), ~np.uint64(0))
    for k in range(n_planes - 1, -1, -1):
        if least >> k & 1:
            equal &= planes[k]
        else:
            above |= equal & planes[k]
            equal &= ~planes[k]
    hit = np.unpackbits((above | equal).view(np.uint8), axis=1, bitorder="little")[:, :len(pd_)]
    return np.nonzero(hit)


def _with_each(step):
    return lambda a: F.transform(step, lambda b: a + b)


def links(classes: DataFrame, dim: int, n: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(counts, edges) between classes (class, n, unit) of distinct unit vectors of one dimension: how many vectors each class is
    linked with, and links that have the components of all of them."""
    spark = classes.sparkSession
    d = math.sqrt(2 - 2 * cosine)
    least = least_count(1.0)
    cuts = cut_count(n)
    share = spark.sparkContext.broadcast(lines(dim))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack([np.frombuffer(b) for b in pdf["unit"]])
                yield pdf.assign(p=list((x @ share.value)[:, :cuts + 1]))
    placed = written(classes.mapInPandas(project, "class long, n long, unit binary, p array<double>"), "projections") \
        .withColumn("side", F.col("p")[cuts])
    medians = placed.agg(*[F.percentile_approx(F.col("p")[j], 0.5, 1000).alias(f"m{j}") for j in range(cuts)]).first() if cuts else []
    reach = reach_of(cuts + 1) * d
    home, visited = F.lit(0).cast("long"), F.array(F.lit(0).cast("long"))
    for j in range(cuts):
        m, p = medians[j], F.col("p")[j]
        home = home + F.when(p >= m, F.lit(1 << j)).otherwise(0)
        step = F.when(p >= m + reach, F.array(F.lit(1 << j))).when(p < m - reach, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1 << j)))
        visited = F.flatten(F.transform(visited, _with_each(step)))
    stored = placed.withColumn("cell", home)
    blocks = stored.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    stored = stored.join(blocks, "cell").select("cell", F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("block"), F.lit(0).alias("asks"), "class", "n", "unit", "side")
    # A query goes to each block of the cells it reaches, in parts of BLOCK queries as well.
    asked = placed.select("class", "n", "unit", "side", F.explode(visited).alias("cell"))
    parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    asked = (asked.join(blocks, "cell").join(parts, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cell", "block", F.pmod(F.xxhash64("class", F.lit(3)), "parts").cast("int").alias("part"), F.lit(1).alias("asks"), "class", "n", "unit", "side"))
    stored = stored.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = asked.unionByName(stored.select(*asked.columns))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("side", kind="stable")
        q, s = pdf[pdf.asks == 1], pdf[pdf.asks == 0]
        if not len(q) or not len(s):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        xq, xs = (np.stack([np.frombuffer(b) for b in f["unit"]]) for f in (q, s))
        pq, ps = xq @ share.value, xs @ share.value
        iq, is_ = q["class"].to_numpy(), s["class"].to_numpy()
        side_q, side_s = q["side"].to_numpy(), s["side"].to_numpy()
        nq, ns = q["n"].to_numpy(), s["n"].to_numpy()
        to_q, to_s, ea, eb = np.zeros(len(q), np.int64), np.zeros(len(s), np.int64), [], []
        for lo in range(0, len(q), 512):
            hi = min(lo + 512, len(q))
            first, last = np.searchsorted(side_s, side_q[lo], "left"), np.searchsorted(side_s, side_q[hi - 1] + reach, "right")
            if first == last:
                continue
            i, j = _colliding(pq[lo:hi], ps[first:last], d, least)
            i, j = i + lo, j + first
            # Each pair is asked for once, by the lower one (of equals by the smaller id).
            ok = (side_q[i] < side_s[j]) | ((side_q[i] == side_s[j]) & (iq[i] < is_[j]))
            i, j = i[ok], j[ok]
            for at in range(0, len(i), 100_000):
                a, b = i[at:at + 100_000], j[at:at + 100_000]
                ok = np.einsum("ij,ij->i", xq[a], xs[b]) >= cosine
                a, b = a[ok], b[ok]
                np.add.at(to_q, a, ns[b])
                np.add.at(to_s, b, nq[a])
                tree = forest(iq[a], is_[b])
                ea += [x for x, _ in tree]
                eb += [y for _, y in tree]
        tree = forest(np.array(ea, np.int64), np.array(eb, np.int64))
        counts = [(x, None, c) for ids, cs in ((iq, to_q), (is_, to_s)) for x, c in zip(ids.tolist(), cs.tolist()) if c]
        return pd.DataFrame([(a, b, 0) for a, b in tree] + counts, columns=["a", "b", "n"]).astype("Int64")
    # applyInPandas: a group is one block of a cell with one part of its queries, 2 * BLOCK rows or so.
    found = written(both.groupBy("cell", "block", "part").applyInPandas(compare, "a long, b long, n long"), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    return counts, found.where("b is not null").select("a", "b")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding; other columns are ignored).

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor do vectors of
    different dimensions link. Equal vectors are one class: its members link with one another and share the class's links.
    Rows that share a vec_id are separate vectors of one id, each with its own links. A vector with a null vec_id has
    links and counts as one, but has component null and isn't kept. An empty table gives no rows.
    """
    prepare(vectors.sparkSession)

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            u = [_unit(v) for v in pdf["embedding"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "unit": [None if x is None else x.tobytes() for x in u], "dim": [0 if x is None else len(x) for x in u]})
    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
                   .mapInPandas(units, "vec_id long, unit binary, dim int"), "units")
    # Classes get numbers of their own: rows that share a vec_id can be in different ones. The table is written, so they stay.
    classes = written(rows.where("unit is not null").groupBy("dim", "unit").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                      .withColumn("class", F.monotonically_increasing_id()), "classes")
    counts = edges = None
    for dim, n in sorted((r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        c, e = links(classes.where(F.col("dim") == dim).select("class", "n", "unit"), dim, n, cosine)
        counts, edges = (c, e) if counts is None else (counts.unionByName(c), edges.unionByName(e))
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    rooted = components(edges).join(classes.select(F.col("class").alias("node"), "least"), "node")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    roots = rooted.join(smallest, "root").select(F.col("node").alias("class"), "component")
    own = (classes.join(counts, "class", "left").join(roots, "class", "left")
           .select("dim", "unit", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "least").alias("component")))
    return rows.join(own, ["dim", "unit"], "left").select(
        "vec_id", F.when(F.col("n").isNotNull(), F.col("n") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
