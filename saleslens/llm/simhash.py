"""SimHash near-dedup by covering locality-sensitive hashing.

A map gives each of the 64 bit positions a vector of r+1 bits; for each of the 2^(r+1)-1 non-zero
vectors v, the mask of v holds the positions whose vector has an odd product with v. Two fingerprints
that differ in at most r positions differ in no position of some mask: the r vectors of the differing
positions do not span the space of r+1 dimensions, so some v is orthogonal to all of them. Hence every
pair within the radius collides in some table; collisions are then checked by exact bit distance.

Equal fingerprints are one node. Buckets of more than ``BLOCK`` nodes are dealt as pairs of blocks to
different tasks, so no task holds a whole bucket; a task sends back a forest of its links, at most one
link a node, and not the pairs.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, free_names, lower_words, prepare, tidy, written
from saleslens.llm.components import components

BITS = 64
#: Fingerprints of one bucket that a task compares with as many others.
BLOCK = 1024
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 values (seed 42) of the word shingles; 0 without words."""
    ws = lower_words(text)
    if not ws:
        return 0
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    joined = b" ".join(ws)
    stops = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = [0, *stops[:-shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    n = len(starts)
    ends = (stops[shingle - 1:] - 1).tolist()
    for lo in range(0, n, 8192):          # bounded memory for very long texts
        h = np.fromiter([digest(joined[i:j], SEED) for i, j in zip(starts[lo:lo + 8192], ends[lo:lo + 8192])], ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n)
    return int.from_bytes(bits.tobytes(), "big")


def masks(radius: int, seed: int = 7) -> list[int]:
    """The 2^(radius+1)-1 masks of the covering family, as unsigned 64-bit values.

    Positions are dealt evenly over the non-zero vectors, so that every mask keeps about half of them.
    """
    top = 1 << (radius + 1)
    vectors = [1 + i % (top - 1) for i in range(BITS)]
    random.Random(seed).shuffle(vectors)
    return [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() & 1) for v in range(1, top)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row, fp as a signed long. Null and empty texts get 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in clean(pdf["text"])], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_hash": pdf["text_hash"], "fp": fp})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       _text_hash().alias("text_hash")) \
        .mapInPandas(tidy(run), "doc_id long, text_hash long, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The links that join two trees when taken in turn: at most one a node."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _linked(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    found_a, found_b = [], []
    for lo in range(0, len(left), 256):
        part = left[lo:lo + 256]
        near = np.bitwise_count((part[:, None] ^ right[None, :]).view(np.uint64)) <= radius
        i, j = np.nonzero(near)
        found_a.append(part[i])
        found_b.append(right[j])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    keep = a != b
    return forest(a[keep], b[keep])


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between distinct fingerprints of column fp whose graph has the components of all
    pairs within ``radius`` bits. fps must be distinct."""
    family = [signed(m) for m in masks(radius)]
    cells = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in family]))
                       .alias("t", "key"))
    # Only buckets of two or more go on; their sizes are partial aggregates.
    size = cells.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = cells.join(size, ["t", "key"])
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = (members.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("fp", "own", F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
                     "t", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows arrive sorted by (task, t, key, p, q): a group is one pair of blocks of one bucket."""
        held: pd.DataFrame | None = None

        def done(pdf: pd.DataFrame) -> pd.DataFrame | None:
            out: list[tuple[int, int]] = []
            cols = pdf[["task", "t", "key", "p", "q"]].to_numpy()
            cut = np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1
            fp, own, p, q = (pdf[c].to_numpy() for c in ("fp", "own", "p", "q"))
            lo_all = np.concatenate([[0], cut]).astype(int)
            hi_all = np.concatenate([cut, [len(pdf)]]).astype(int)
            two = (hi_all - lo_all) == 2          # most buckets: both rows at once
            x, y = fp[lo_all[two]], fp[lo_all[two] + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            out += zip(x[near].tolist(), y[near].tolist())
            for lo, hi in zip(lo_all[~two], hi_all[~two]):
                if hi - lo > 1:
                    f, o = fp[lo:hi], own[lo:hi]
                    if p[lo] == q[lo]:
                        out += _linked(f, f, radius)
                    else:
                        out += _linked(f[o == p[lo]], f[o == q[lo]], radius)
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64") if out else None
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            last = pdf.iloc[-1] if len(pdf) else None
            if last is None:
                continue
            same = np.ones(len(pdf), bool)
            for c in ("task", "t", "key", "p", "q"):
                same &= pdf[c].to_numpy() == last[c]
            held, pdf = pdf[same], pdf[~same]
            if len(pdf) and (out := done(pdf.reset_index(drop=True))) is not None:
                yield out
        if held is not None and len(held) and (out := done(held.reset_index(drop=True))) is not None:
            yield out
    order = ["task", "t", "key", "p", "q"]
    return dealt.repartition("task").sortWithinPartitions(*order).mapInPandas(tidy(compare), "a long, b long").distinct()


def _placed(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """fingerprints() of docs, written, and (fp, root, least_id) of the distinct ones: least_id is the fingerprint's
    smallest doc_id, root the smallest fingerprint of its component."""
    prepare(docs.sparkSession)
    fp = written(fingerprints(docs, shingle), "fingerprints")
    nodes = fp.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    linked = components(near_links(nodes.select("fp"), radius))
    return fp, nodes.join(linked, nodes.fp == linked.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))


def simhash_dedup(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) for each row of docs (doc_id, text; more columns are ignored).

    component_id is the smallest doc_id reachable by links of ``radius`` bits or fewer, kept marks that
    document. A null or empty text has fingerprint zero, linked like any other. Rows that share a doc_id
    get one row each; of rows with a null doc_id, component_id is that of the fingerprint's documents, and
    null if there are only such rows; kept is false for them. An empty table gives no rows.
    """
    fp, placed = _placed(docs, shingle, radius)
    # The component's smallest doc_id: roots are fingerprints, so take the minimum over their documents.
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_fp = placed.join(smallest, "root").select("fp", "component_id")
    return fp.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of docs, with all their columns, of which the operator keeps one a component.

    That is the row with the smallest doc_id (null ids last), of rows that share it the one with the smallest
    text hash. Rows that share a doc_id but whose texts are of two components keep one row each. Texts without
    words have fingerprint zero and so are one group, too. An empty table gives no rows.
    """
    fp, placed = _placed(docs, shingle, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("first")
    own, name, text_hash = free_names(docs, "text_hash", "name", "chosen_hash")
    # Each component's fingerprints are reduced first, so a large one is one row a task and fingerprint.
    least = fp.groupBy("fp").agg(first)
    chosen = written(least.join(placed, "fp").groupBy("root").agg(F.min("first").alias("first"))
                     .select(F.col("first.doc_id").alias(name), F.col("first.text_hash").alias(text_hash)), "kept")
    keyed = docs.withColumn(own, _text_hash())
    some = keyed.join(chosen, keyed["doc_id"].cast("long").eqNullSafe(F.col(name)) & (F.col(own) == F.col(text_hash)), "left_semi")
    return some.dropDuplicates(["doc_id", own]).select(*docs.columns)
