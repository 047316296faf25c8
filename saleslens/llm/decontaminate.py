"""Benchmark decontamination with DataFrame functions alone.

A document is contaminated by an item if some window of it, as many words long as the item, has a weighted
shingle similarity of ``SIMILARITY`` or more with the item: shingles of five lower-case words, weighted by how
often they occur, sum of the smaller over sum of the larger weights.

Windows start at each place where a document shares a shingle with an item of that size, or end with the document.
These are enough for the highest similarity: a window that starts on a shingle of no item can move on to the next
shared one, or to the document's end, and loses nothing shared. In whatever order the parts of a passage stand, the window
that covers them is laid. Of these, windows with too few shared places to reach ``SIMILARITY`` are left out, which is
exact, too. Each window's SimHash is compared with those of
the items of its size by a multi-index: 64 bits are cut into ``RADIUS`` + 1 blocks, and two fingerprints that
differ in at most RADIUS bits agree in a block. Pairs within the radius are then checked exactly. At a similarity of
0.8 the two shingle vectors are 27 degrees apart, some 10 bits of 64; the radius is 20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import prepare, written
from saleslens.llm.substrings import key_of

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
#: Rows of a table that is broadcast, at most (a few longs a row); a larger one is joined by a shuffle.
BROADCAST_ROWS = 300_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = "\t\n\v\f\r"


def word_array(text: Column) -> Column:
    """The words between white space, A-Z in lower case: white space becomes spaces, at which a split needs no pattern."""
    return F.array_remove(F.split(F.translate(text, UPPER + WHITE, LOWER + " " * len(WHITE)), " "), "")


def shingle_hashes(words: str) -> Column:
    """Hashes of the shingles of an array column, in order; fewer words than a shingle are one."""
    w, n = F.col(words), F.size(words)
    return (F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))))
            .when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>")))


def placed_shingles(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, p, h): the hashes of shingle_hashes("w") one a row with their places, n the words of the text.

    The array of words is laid beside itself, moved by a word each time, so that a row has a shingle's words as columns
    and is hashed by generated code. Words that a text's end lacks are null, which a hash leaves out."""
    moved = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{i}") for i in range(SHINGLE)])
    rows = texts.select(*keys, F.size("w").alias("n"), F.posexplode(moved).alias("p", "s"))
    return (rows.where(F.col("p") <= F.greatest(F.col("n") - SHINGLE, F.lit(0)))
            .select(*keys, "n", "p", F.xxhash64(*[F.col("s").getField(f"w{i}") for i in range(SHINGLE)]).alias("h")))


def _add_bit(b: int):
    return lambda acc, h: acc + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1)).cast("int")


def simhash(hashes: str) -> Column:
    """Majority bits of an array of hashes."""
    n, out = F.size(hashes), F.lit(0).cast("long")
    for b in range(64):
        ones = F.aggregate(hashes, F.lit(0), _add_bit(b))
        out = out.bitwiseOR(F.when(ones * 2 > n, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return out


def blocks(fp: str) -> Column:
    """The multi-index keys: each block of bits with its number."""
    cuts = [round(64 * i / (RADIUS + 1)) for i in range(RADIUS + 2)]
    return F.array(*[F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (z - a)) - 1)) * 64 + i for i, (a, z) in enumerate(zip(cuts, cuts[1:]))])


def similarity(a: str, b: str) -> Column:
    """Sum of smaller over sum of larger weights of two multisets of hashes."""
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, h: acc + F.least(
        F.size(F.filter(a, lambda x: x == h)), F.size(F.filter(b, lambda x: x == h))))
    return common / (F.size(a) + F.size(b) - common)


def window_starts(places: Column, n: Column, m: Column) -> Column:
    """Starts of the windows of m words in a text of n that can reach SIMILARITY, from the sorted places of shared shingles."""
    a, b = F.greatest(F.least(n, m) - (SHINGLE - 1), F.lit(1)), F.greatest(m - (SHINGLE - 1), F.lit(1))
    least = F.greatest(F.ceil(SIMILARITY * (a + b) / (1 + SIMILARITY) - 1e-6).cast("int"), F.lit(1))
    last = F.greatest(n - m, F.lit(0))
    # The window has enough places if the least-th from its first lies in it, too.
    inner = F.filter(places, lambda p, i: (p < last) & (F.get(places, i + least - 1) < p + a))
    return F.when(F.get(places, F.size(places) - least) >= last, F.concat(inner, F.array(last))).otherwise(inner)


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has BROADCAST_ROWS rows at most."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, item_id, similarity), written: texts (by key) with the items that contaminate them, and the highest similarity."""
    prepare(docs.sparkSession)
    items = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_array(F.col("text").cast("string")).alias("w"))
                    .where("size(w) > 0").withColumns({"m": F.size("w"), "hi": shingle_hashes("w")}).drop("w")
                    .withColumn("fi", simhash("hi")), "items")
    seeds = _small(written(items.select("m", F.explode("hi").alias("h")).distinct(), "seeds"))
    keyed = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").select("text", *key_of("text"))
    at = placed_shingles(keyed.select("k1", "k2", word_array(F.col("text")).alias("w")), "k1", "k2")
    places = at.join(seeds, "h").groupBy("k1", "k2", "n", "m").agg(F.array_sort(F.collect_set("p")).alias("places"))
    starts = places.select("k1", "k2", "m", F.explode(window_starts(F.col("places"), F.col("n"), F.col("m"))).alias("start"))
    starts = written(starts, "starts")
    texts = keyed.join(_small(written(starts.select("k1", "k2").distinct(), "keys")), ["k1", "k2"], "left_semi") \
        .dropDuplicates(["k1", "k2"]).select("k1", "k2", word_array(F.col("text")).alias("w"))
    windows = written(texts.join(starts, ["k1", "k2"]).select("k1", "k2", "m", F.slice("w", F.col("start") + 1, F.col("m")).alias("w"))
                      .select("k1", "k2", "m", shingle_hashes("w").alias("hw")).distinct()
                      .withColumn("fw", simhash("hw")), "windows")
    # Windows and items of one size that agree in a block of bits, then the exact bit distance.
    index = _small(written(items.select("item_id", "m", "fi", "hi", F.explode(blocks("fi")).alias("b")), "index"))
    near = (windows.withColumn("b", F.explode(blocks("fw"))).join(index, ["m", "b"])
            .where(F.bit_count(F.col("fw").bitwiseXOR(F.col("fi"))) <= RADIUS)
            .select("k1", "k2", "item_id", "hw", "hi").distinct())
    return written(near.withColumn("similarity", similarity("hw", "hi")).where(F.col("similarity") >= SIMILARITY)
                   .groupBy("k1", "k2", "item_id").agg(F.max("similarity").alias("similarity")), "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity): one row for each row of docs and item that contaminates it.

    Null and empty texts match nothing, and items without words are left out; items that share an id count as one, with the
    higher similarity. Rows of docs with one doc_id or none get their own rows. Empty tables give no rows.
    """
    found = matches(docs, benchmark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", *key_of("text"))
    return rows.join(_small(found), ["k1", "k2"]).select("doc_id", "item_id", "similarity")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that no item contaminates; rows with a null text stay."""
    gone = written(matches(docs, benchmark).select(F.col("k1").alias("__c1"), F.col("k2").alias("__c2")).distinct(), "contaminated")
    k1, k2 = key_of("text")
    return (docs.withColumn("__k1", k1).withColumn("__k2", k2)
            .join(_small(gone), (F.col("__k1") == F.col("__c1")) & (F.col("__k2") == F.col("__c2")), "left_anti").drop("__k1", "__k2"))
