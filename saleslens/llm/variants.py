"""Spelling variants: words one inserted, deleted or replaced letter apart, by dense prefix-suffix tiling.

Two words are one edit apart if they differ and their common prefix and common suffix together reach the
longer length minus one. So one of the two covers half of that: the words meet among those that share
their first or last m div 2 letters, m the longer length. Such a group is cut into blocks, pairs of
blocks are dealt to tasks, and a task compares two blocks at once as padded matrices of code points
(below 256, so one byte each), column by column: no group is one task, and what a task sends back is
one row a word, not the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import prepare, rows_of, tidy, written

#: Distinct words that a task counts before it sends them on.
HELD = 200_000
#: Words of a block, and letters if they are long.
BLOCK, BLOCK_BYTES = 4096, 1 << 22
#: Rows of a dense tile's side; groups up to SMALL go through lists of pairs, CHUNK pairs at a time.
TILE, SMALL, CHUNK = 512, 48, 1 << 18


def noisy_words(doc_id, text: str | None, least: int, every: int) -> Iterator[tuple[bytes, int]]:
    """(word as Latin-1 bytes, occurrences) of the runs of letters of one document.

    Where ``every`` divides the crc32 h of ``doc_id:run``, the run loses its letter h % length. Runs too
    short to reach ``least`` letters are not looked at. A null doc_id is the empty text.
    """
    if not text:
        return
    runs = re.findall(rb"[A-Za-z\xC0-\xFF]{%d,}" % least, text.encode("latin-1", "replace"))
    prefix = zlib.crc32(("" if doc_id is None else f"{doc_id}").encode() + b":")
    for w, n in Counter(map(bytes.lower, runs)).items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), prefix)
        if h % every == 0:
            i = h % len(w)
            w = w[:i] + w[i + 1:]
            if len(w) < least:
                continue
        yield w, n


def word_counts(docs: DataFrame, least: int = 7, every: int = 31, min_count: int = 2) -> DataFrame:
    """(word, n) of all documents; words of ``least`` code points and ``min_count`` occurrences or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            pdf = pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})
            held.clear()
            return pdf
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            for w, n in noisy_words(doc_id, text, least, every):
                held[w] += n
            if len(held) >= HELD:
                yield out()
        if held:
            yield out()
    parts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInPandas(tidy(run), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _groups(words: DataFrame) -> DataFrame:
    """(word, n, side, m, piece, p, q, own): each row a word in one pair of blocks (p, q) of one group."""
    size = F.length("word")

    def keys(m):
        half = F.floor(m / 2).cast("int")
        return [F.struct(F.lit(0).alias("side"), m.alias("m"), F.left("word", half).alias("piece")),
                F.struct(F.lit(1).alias("side"), m.alias("m"), F.right("word", half).alias("piece"))]
    rows = words.select("word", "n", F.explode(F.array(*keys(size), *keys(size + 1))).alias("g")).select("word", "n", "g.*")
    sizes = rows.groupBy("side", "m", "piece").agg(F.count("*").alias("members")).where("members > 1")
    members = rows.join(sizes, ["side", "m", "piece"])
    block = F.greatest(F.lit(16), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / F.col("m"))))
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = (members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return dealt.select("word", "n", "side", "m", "piece", "own",
                        F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))


class Block:
    """Words of one (side, m) as two matrices of code points, a row a column: flush left and flush right."""

    def __init__(self, words: list[bytes], m: int):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.left = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m).T.copy()
        self.right = np.frombuffer(b"".join(w.rjust(m, b"\0") for w in words), np.uint8).reshape(len(words), m).T[::-1].copy()


def _run(columns: np.ndarray, a, b, start: int, stop: int, shape) -> np.ndarray:
    """Length of the common run from column ``start`` on, at most up to ``stop``."""
    same = np.ones(shape, bool)
    length = np.zeros(shape, np.int32 if stop > 250 else np.uint8)
    for c in range(start, stop):
        same &= columns[c][a] == columns[c][b]
        if not same.any():
            break
        length += same
    return length


def one_edit(block: Block, a, b, side: int, m: int, shape) -> np.ndarray:
    """Which pairs (a, b) of words that share ``m div 2`` letters at ``side`` are one edit apart, m the longer length.

    Pairs of the last letters' group that share the first ones, too, are left to that group.
    """
    half = m // 2
    near, far = (block.left, block.right) if side == 0 else (block.right, block.left)
    other = _run(far, a, b, 0, half if side else m - 1 - half, shape)
    if side == 0:
        return _run(near, a, b, half, m, shape).astype(np.int32) + other >= m - 1 - half
    reached = _run(near, a, b, half, m, shape).astype(np.int32) + other >= m - 1 - half
    return reached & (other < half)


def _dense(block: Block, rows: np.ndarray, cols: np.ndarray, side: int, m: int, within: bool):
    """Pairs of two lists of words, tile by tile; ``within``: the lists are one, and each pair counts once."""
    step = max(1, min(TILE, BLOCK_BYTES // m))
    for i in range(0, len(rows), step):
        for j in range(i if within else 0, len(cols), step):
            r, c = rows[i:i + step], cols[j:j + step]
            hit = one_edit(block, r[:, None], c[None, :], side, m, (len(r), len(c)))
            x, y = np.nonzero(hit)
            x, y = r[x], c[y]
            yield (x[x < y], y[x < y]) if within and i == j else (x, y)


def _listed(block: Block, starts: np.ndarray, sizes: np.ndarray, side: int, m: int):
    """Pairs of many small groups at once: the rows of group g are starts[g] to starts[g] + sizes[g]."""
    for lo in range(0, len(starts), max(1, CHUNK // (SMALL * SMALL))):
        s, z = starts[lo:lo + CHUNK // (SMALL * SMALL)], sizes[lo:lo + CHUNK // (SMALL * SMALL)]
        group = np.repeat(np.arange(len(s)), z * z)
        k = np.arange(len(group)) - np.repeat(np.cumsum(z * z) - z * z, z * z)
        i, j = s[group] + k // z[group], s[group] + k % z[group]
        take = (i < j) & ((block.size[i] == m) | (block.size[j] == m))
        i, j = i[take], j[take]
        hit = one_edit(block, i, j, side, m, len(i))
        yield i[hit], j[hit]


def _pairs(pdf: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All near pairs, as row numbers, of rows sorted by (m, side, piece, p, q); groups are whole."""
    words = [w.encode("latin-1") for w in pdf["word"]]
    m, side, own, p, q = (pdf[c].to_numpy() for c in ("m", "side", "own", "p", "q"))
    piece = pdf["piece"].to_numpy()
    new = np.ones(len(pdf), bool)
    new[1:] = (m[1:] != m[:-1]) | (side[1:] != side[:-1]) | (piece[1:] != piece[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(pdf))
    found = []
    kinds = np.flatnonzero(np.append(True, (m[starts][1:] != m[starts][:-1]) | (side[starts][1:] != side[starts][:-1])))
    for g0, g1 in zip(kinds, np.append(kinds[1:], len(starts))):
        first, length, at = starts[g0], int(m[starts[g0]]), int(side[starts[g0]])
        block = Block(words[first:ends[g1 - 1]], length)
        s, z = starts[g0:g1] - first, ends[g0:g1] - starts[g0:g1]
        small = (z <= SMALL) & (p[starts[g0:g1]] == q[starts[g0:g1]])
        hits = list(_listed(block, s[small], z[small], at, length))
        for lo, n in zip(s[~small], z[~small]):
            rows = np.arange(lo, lo + n)
            whole, mine = block.size[rows] == length, own[first + rows]
            a, b = p[first + lo], q[first + lo]
            if a == b:
                hits += _dense(block, rows[whole], rows[whole], at, length, True)
                hits += _dense(block, rows[whole], rows[~whole], at, length, False)
            else:
                hits += _dense(block, rows[whole & (mine == a)], rows[mine == b], at, length, False)
                hits += _dense(block, rows[whole & (mine == b)], rows[~whole & (mine == a)], at, length, False)
        found += [(x + first, y + first) for x, y in hits]
    if not found:
        return words, np.empty(0, np.int64), np.empty(0, np.int64)
    return words, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best struct<minus_n, word>) of the words (word, n; distinct) that have a near word."""
    order = ["m", "side", "piece", "p", "q"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def done(pdf: pd.DataFrame) -> pd.DataFrame:
            _, x, y = _pairs(pdf.reset_index(drop=True))
            word, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
            out = pd.DataFrame({"word": word[np.append(x, y)], "near": word[np.append(y, x)], "minus_n": -n[np.append(y, x)]})
            out = out.sort_values(["word", "minus_n", "near"], kind="stable")
            out["n_near"] = out.groupby("word", sort=False)["near"].transform("size")
            return out.drop_duplicates("word")[["word", "n_near", "minus_n", "near"]]
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf.iloc[-1]
            open_ = np.logical_and.reduce([(pdf[c] == last[c]).to_numpy() for c in order])
            held = pdf[open_]
            if not open_.all():
                yield done(pdf[~open_])
        if held is not None and len(held):
            yield done(held)
    dealt = _groups(words).repartition(*order).sortWithinPartitions(*order)
    found = dealt.mapInPandas(tidy(compare), "word string, n_near long, minus_n long, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct("minus_n", F.col("near").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form (word, form): the last of the chain of forms.

    A form occurs at least ``ratio`` times as often as its word, so chains end. Every round doubles the
    steps that have been followed; it is written, so a lost executor costs one round.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if state.join(ahead, "root", "left_semi").isEmpty():
            return state
        state = written(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, least: int = 7, every: int = 31, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of docs (doc_id, text; more columns are ignored).

    Words, their noise and their counts are those of ``word_counts``. A word's form is the near word that
    occurs most often (ties: the smallest in code-point order) if that is at least ``ratio`` (over 1) times as
    often as the word. Null and empty texts have no words, repeated rows count each time, an empty table
    gives no rows; a run of letters may be of any length.
    """
    prepare(docs.sparkSession)
    words = written(word_counts(docs, least, every, min_count), "words")
    near = near_words(words)
    form_n = -F.col("best.minus_n")
    has = form_n >= ratio * F.col("n")
    joined = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best.word")).alias("form"), F.when(has, form_n).alias("form_n")), "forms")
    found = roots(joined.where(F.col("form").isNotNull()))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
