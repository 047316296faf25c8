"""Phrase collocation mining with broadcast double-array tries.

1. Words are counted per language. Texts become arrays of 64-bit word hashes (a hash covers language and
   word; a seed without any collision among all words is looked for, so a hash is a word), 0 where a piece
   ends or the word is too rare to be part of a frequent phrase.
2. Candidates, a length at a time (Apriori): a phrase is looked at where both its parts without the last
   and without the first word may be frequent. That test is a bitmap of hashed phrases, of fixed size at
   any input; a false positive costs a candidate, and no frequent phrase is lost.
3. The candidates of all lengths are dealt to shards of at most ``SHARD`` phrases. A shard's phrases become
   a double-array trie, which is broadcast; numpy moves the states of all positions of a batch of texts on
   by one word at once, level by level, and counts the accepting states it meets. These exact counts are
   summed over tasks. More phrases make more shards, each a pass over the hashes, never a larger broadcast.
4. Scores are exact decimals; cuts and containing phrases are joins of the frequent phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslens.llm.common import prepare, rows_of, tidy, written

SEED = 42
#: Distinct words, or phrases' positions, that a task gathers before it sends their counts on.
HELD, GATHER = 300_000, 1 << 21
#: Positions whose hashes are worked on at once, and rows that a task sends on at once: arrays of all that a task
#: gathers would take hundreds of MB in each Python worker, and as one Arrow batch as much outside the JVM's heap.
SLICE, ROWS = 1 << 18, 1 << 17
#: Bits of the bitmap of hashed phrases: 8 MB.
BITS = 26
#: Counts of a row when tasks' sums are added up.
CHUNK = 1 << 12
#: Phrases of a trie. Its arrays have some 60 bytes a phrase.
SHARD = 1 << 18
ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
NONE = "und"


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, and b"." where a piece ends."""
    return text.encode("utf-8", "surrogatepass").lower().translate(ENDS).replace(b".", b" . ").split()


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
                       F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) over all texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pd.DataFrame]:
            for lang, c in held.items():
                c.pop(b".", None)
                yield pd.DataFrame({"lang": lang, "word": [w.decode("utf-8", "surrogatepass") for w in c],
                                    "f": np.fromiter(c.values(), np.int64, len(c))})
            held.clear()
        for lang, text in rows_of(batches, "lang", "text"):
            held.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, held.values())) >= HELD:
                yield from out()
        yield from out()
    parts = _source(docs).mapInPandas(tidy(run), "lang string, word string, f long")
    return parts.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def hashed(words: DataFrame) -> tuple[DataFrame, int]:
    """words with their hash h, and the salt for which no two words have the same."""
    for salt in range(100):
        h = words.withColumn("h", F.xxhash64(F.lit(str(salt)), "lang", "word")).where("h != 0")
        n = h.agg(F.count("*").alias("n"), F.count_distinct("h").alias("m")).first()
        if n.n == n.m and n.n == words.count():
            return h, salt
    raise ValueError("no salt keeps the words' hashes apart")


class Bitmap:
    """A set of hashes as 2**BITS bits: what is in it is always found, other hashes now and then."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, df: DataFrame, h: str) -> Bitmap:
        """Built by Spark in parts of 4 KB, of which there are at most 2**(BITS - 15)."""
        bucket = F.col(h).bitwiseAND(F.lit((1 << BITS) - 1))
        part = df.groupBy(F.shiftright(bucket, 15).cast("int").alias("part")).agg(
            F.bitmap_construct_agg(bucket.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        bits = np.zeros((1 << BITS - 15, 1 << 12), np.uint8)
        for r in part.collect():
            bits[r.part] = np.frombuffer(r.bits, np.uint8)
        return cls(bits.reshape(-1))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        b = h & ((1 << BITS) - 1)
        return (self.bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1


def mix(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase made longer by one word."""
    with np.errstate(over="ignore"):
        x = (phrase.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ word.view(np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def encoded(docs: DataFrame, words: DataFrame, salt: int) -> DataFrame:
    """(ids): each text as the hashes of its words; 0 ends a piece or stands for a word not in ``words``."""
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(Bitmap.of(words, "h").bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maybe, seeds, held = Bitmap(known.value), {}, {}
        for pdf in batches:
            out = []
            for lang, text in rows_of([pdf], "lang", "text"):
                seed = seeds.setdefault(lang, xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"),
                                                                    xxhash.xxh64_intdigest(str(salt), SEED)))
                ws = tokens(text)
                cache = held.setdefault(lang, {b".": 0})
                for w in set(ws):
                    if w not in cache:
                        cache[w] = xxhash.xxh64_intdigest(w, seed)
                out.append(np.fromiter(map(cache.__getitem__, ws), np.uint64, len(ws)).view(np.int64))
                if sum(map(len, held.values())) >= HELD:
                    held.clear()
            ids = [np.where(maybe(x), x, 0).tobytes() for x in out]
            yield pd.DataFrame({"ids": ids}, dtype=object)
    return _source(docs).mapInPandas(tidy(run), "ids binary")


def _arrays(batches, size: int) -> Iterator[np.ndarray]:
    """The texts' hashes, many in one array, with a 0 after each; about ``size`` of them, whole texts."""
    held, n = [], 0
    for (ids,) in rows_of(batches, "ids"):
        held += [np.frombuffer(ids, np.int64), np.zeros(1, np.int64)]
        n += len(held[-2]) + 1
        if n >= size:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _starts(x: np.ndarray, maps: list[Bitmap], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of ``length`` words, by start, hash, hash of what comes before the last word, and that, whose
    parts without the first and without the last word are in the bitmaps of their lengths."""
    at = np.flatnonzero(x != 0)
    h = x[at]
    parent = last = at[:0]
    for k in range(2, length + 1):
        ok = maps[k - 2](h)
        at, h = at[ok], h[ok]
        go = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, parent = at[go], h[go]
        last = x[at + k - 1]
        h = mix(parent, last)
    return at, h, parent, last


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & 0xFFFFFFFF).astype(np.uint32)


def possible(texts: DataFrame, known: list, length: int, longest: int) -> DataFrame:
    """One pass over the texts' hashes; ``known`` are the bitmaps of the phrases of 1 to ``length`` words.

    Rows with h: the phrases of ``length`` words that are in their bitmap, as (h, parent, last), for lengths
    from 2 on. Rows without: (bucket, c), how often 32 bits of the hashes of phrases one word longer occur.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps = [Bitmap(b.value) for b in known]
        found, buckets, n = [], [], 0

        def out() -> Iterator[pd.DataFrame]:
            if found:
                h, parent, last = (np.concatenate(c) for c in zip(*found))
                found.clear()
                h, i = np.unique(h, return_index=True)
                parent, last = parent[i], last[i]
                for lo in range(0, len(h), ROWS):
                    u = h[lo:lo + ROWS]
                    yield pd.DataFrame({"bucket": pd.array([pd.NA] * len(u), "Int32"), "c": pd.array([pd.NA] * len(u), "Int32"),
                                        "h": u, "parent": parent[lo:lo + ROWS], "last": last[lo:lo + ROWS]})
            if buckets:
                all_buckets = np.concatenate(buckets)
                buckets.clear()
                u, c = np.unique(all_buckets, return_counts=True)
                u, c = u.view(np.int32), c.astype(np.int32)
                for lo in range(0, len(u), ROWS):
                    none = pd.array([pd.NA] * len(u[lo:lo + ROWS]), "Int64")
                    yield pd.DataFrame({"bucket": u[lo:lo + ROWS], "c": c[lo:lo + ROWS], "h": none, "parent": none, "last": none})
        for x in _arrays(batches, SLICE):
            if length > 1:
                _, h, parent, last = _starts(x, maps, length)
                ok = np.flatnonzero(maps[length - 1](h))
                u, i = np.unique(h[ok], return_index=True)
                found.append((u, parent[ok[i]], last[ok[i]]))
                del h, parent, last
            if length < longest:
                buckets.append(_bucket(_starts(x, maps, length + 1)[1]))
            n += len(x)
            if n >= GATHER:
                yield from out()
                n = 0
        yield from out()
    return texts.mapInPandas(tidy(run), "bucket int, c int, h long, parent long, last long")


def frequent_buckets(counted: DataFrame, least: int) -> DataFrame:
    """(h): the buckets, in the low bits of a long, that occur ``least`` times."""
    return (counted.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("c").alias("c"))
            .where(F.col("c") >= least).select(F.col("bucket").cast("long").alias("h")))


class Trie:
    """A double array: state s goes on by code c to base[s] + c if check there is s; accept names phrases from 1."""

    def __init__(self, paths: np.ndarray):
        """``paths``: distinct rows of word hashes, one a phrase, 0 after its end."""
        self.words = np.unique(paths[paths != 0])
        code = np.where(paths != 0, np.searchsorted(self.words, paths) + 1, 0).astype(np.int64)
        room = 4 * int((code != 0).sum()) + 2 * len(self.words) + 16
        self.base = np.zeros(room, np.int32)
        self.check = np.full(room, -1, np.int32)
        self.check[0] = 0
        self.accept = np.zeros(room, np.int32)
        state = np.zeros(len(paths), np.int64)                       # where each phrase's path stands
        rows = np.arange(len(paths))
        for level in range(paths.shape[1]):
            rows = rows[code[rows, level] != 0]
            if not len(rows):
                break
            edge = np.unique(np.stack([state[rows], code[rows, level]], 1), axis=0)
            self._place(edge[:, 0], edge[:, 1])
            state[rows] = self.base[state[rows]] + code[rows, level]
            done = rows[(code[rows, level + 1] == 0) if level + 1 < paths.shape[1] else np.ones(len(rows), bool)]
            self.accept[state[done]] = done + 1
        for name in ("base", "check", "accept"):
            setattr(self, name, getattr(self, name)[:np.flatnonzero(self.check >= 0)[-1] + 1])

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Finds a base for each parent: those with most children first, at the first of some places that is free."""
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        sizes = np.diff(np.append(starts, len(parents)))
        rng = np.random.default_rng(len(parents))
        for g in np.argsort(-sizes, kind="stable"):
            if sizes[g] == 1:
                break
            c = codes[starts[g]:starts[g] + sizes[g]]
            while True:
                tries = np.append(0, rng.integers(0, max(1, len(self.check) - c[-1]), 32)) if len(self.check) > c[-1] else np.array([0])
                tries = tries[tries + c[-1] < len(self.check)]
                fits = np.flatnonzero((self.check[tries[:, None] + c] < 0).all(axis=1)) if len(tries) else tries
                if len(fits):
                    break
                self._grow(len(self.check) + int(c[-1]) + 1)
            self._set(parents[starts[g]], tries[fits[0]], c)
        single = starts[sizes == 1]
        free = np.flatnonzero(self.check < 0)
        if len(free) < len(single):
            end = len(self.check)
            self._grow(end + len(single))
            free = np.append(free, np.arange(end, len(self.check)))
        self._set(parents[single], free[:len(single)] - codes[single], codes[single])

    def _set(self, parent, base, codes) -> None:
        self.base[parent] = base
        self.check[base + codes] = parent

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        self.base, self.accept = (np.append(a, np.zeros(more, np.int32)) for a in (self.base, self.accept))
        self.check = np.append(self.check, np.full(more, -1, np.int32))

    def count(self, x: np.ndarray, into: np.ndarray) -> None:
        """Adds to ``into``, by phrase, how often each starts at a position of x; all positions at once."""
        code = np.searchsorted(self.words, x)
        code[code == len(self.words)] = 0
        code = np.where((self.words[code] == x) & (x != 0), code + 1, 0) if len(self.words) else np.zeros(len(x), np.int64)
        at, state, level = np.flatnonzero(code), np.zeros(np.count_nonzero(code), np.int64), 0
        while len(at):
            c = code[at + level]
            to = self.base[state] + c
            ok = (c > 0) & (to >= 0) & (to < len(self.check))
            ok[ok] = self.check[to[ok]] == state[ok]
            at, state, level = at[ok], to[ok], level + 1
            into += np.bincount(self.accept[state], minlength=len(into))
            inside = at + level < len(x)
            at, state = at[inside], state[inside]


def trie_counts(texts: DataFrame, phrases: DataFrame, longest: int) -> DataFrame:
    """(id, f): exact occurrences of the phrases (id, path array<long>; written) in the texts' hashes."""
    spark = texts.sparkSession
    shards = -(-phrases.count() // SHARD)
    cols = [F.coalesce(F.get("path", F.lit(i)), F.lit(0).cast("long")).alias(f"p{i}") for i in range(longest)]
    out = None
    for shard in range(shards):
        mine = phrases.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard).select("id", *cols).toPandas()
        ids = mine["id"].to_numpy(np.int64)
        trie = Trie(mine[[f"p{i}" for i in range(longest)]].to_numpy(np.int64))
        shared = spark.sparkContext.broadcast((trie, ids))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            trie, ids = shared.value
            total = np.zeros(len(ids) + 1, np.int64)
            for x in _arrays(batches, SLICE):
                trie.count(x, total)
            chunks = range(0, len(ids), CHUNK)
            yield pd.DataFrame({"chunk": np.array(chunks, np.int32) // CHUNK,
                                "counts": [total[1 + i:1 + i + CHUNK].tobytes() for i in chunks]})

        def add(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            """Rows come by chunk: one vector is held and added to, however many tasks there were."""
            _, ids = shared.value
            at, total = None, None
            for chunk, counts in rows_of(batches, "chunk", "counts"):
                more = np.frombuffer(counts, np.int64)
                if chunk == at:
                    total += more
                    continue
                if at is not None:
                    yield pd.DataFrame({"id": ids[at * CHUNK:(at + 1) * CHUNK], "f": total})
                at, total = chunk, more.copy()
            if at is not None:
                yield pd.DataFrame({"id": ids[at * CHUNK:(at + 1) * CHUNK], "f": total})
        vectors = texts.mapInPandas(tidy(run), "chunk int, counts binary").repartition("chunk").sortWithinPartitions("chunk")
        # A shard's counts are written before the next trie is made.
        part = written(vectors.mapInPandas(tidy(add), "id long, f long"), "phrase-counts")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "id long, f long")


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of 1 to ``longest`` words found ``least`` times or more, and (lang, n)."""
    spark = docs.sparkSession
    counted = written(word_counts(docs), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words, salt = hashed(counted)
    often = written(words.where(F.col("f") >= least), "frequent-words")
    texts = written(encoded(docs, often, salt), "word-hashes")
    one = often.select("lang", F.array("word").alias("words"), "f")
    known, found, level = [spark.sparkContext.broadcast(Bitmap.of(often, "h").bits)], None, often.select(
        "h", "lang", F.array("word").alias("words"), F.array("h").alias("path"))
    if longest > 1:
        seen = possible(texts, known, 1, longest)
    for length in range(2, longest + 1):
        known.append(spark.sparkContext.broadcast(Bitmap.of(frequent_buckets(seen, least), "h").bits))
        seen = written(possible(texts, known, length, longest), f"possible-{length}")
        new = seen.where(F.col("h").isNotNull()).select("h", "parent", "last").distinct()
        before = level.select(F.col("h").alias("parent"), "lang", "words", "path")
        last = often.select(F.col("h").alias("last"), "word")
        level = written(new.join(before, "parent").join(last, "last").select(
            "h", "lang", F.concat("words", F.array("word")).alias("words"),
            F.concat("path", F.array("last")).alias("path")), f"candidates-{length}")
        found = level if found is None else found.unionByName(level)
    if found is None:
        return one, totals
    phrases = written(found.select(F.monotonically_increasing_id().alias("id"), "lang", "words", "path"), "candidates")
    counts = trie_counts(texts, phrases.select("id", "path"), longest).where(F.col("f") >= least)
    return one.unionByName(phrases.join(counts, "id").select("lang", "words", "f")), totals


def _long_decimal(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, within: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of docs (doc_id, text, lang).

    A phrase has 2 to ``longest`` words and a >= ``least`` occurrences. Cut after its first words it has l and
    r occurrences of its parts and score floor(1000 a n / (l r)); the cut with the lowest score counts, the
    first of equal ones. A phrase goes if a phrase one or more words longer contains it and has at least
    ``within`` per cent of its occurrences (one word longer is enough to look at: counts fall with length).
    A null lang is ``und``; null and empty texts have no words; repeated rows count each time; an empty table
    gives no rows; columns beyond text and lang are ignored.
    """
    prepare(docs.sparkSession)
    found, totals = frequent_phrases(docs, longest, least)
    found = written(found, "phrases")
    size = F.size("words")
    phrases = found.where(size >= 2)
    ends = found.where(size >= 3).select("lang", F.col("f").alias("longer"), F.explode(F.array(
        F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"))
    inside = ends.groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    stays = (phrases.join(inside, ["lang", "words"], "left")
             .where(F.col("longer").isNull() | (100 * _long_decimal("longer") < within * _long_decimal("f"))))
    cuts = stays.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"))
    part = found.select("lang", F.col("words").alias("part"), "f")
    cuts = (cuts.join(part.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(part.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
            .join(totals, "lang"))
    score = F.expr("(cast(a as decimal(38,0)) * n * 1000) div (cast(l as decimal(38,0)) * r)").cast("long")
    lowest = (cuts.withColumn("score", score).groupBy("lang", "words", "a", "n")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    rows = lowest.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
