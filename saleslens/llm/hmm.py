"""A hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores.

Tokens are lower-cased words and one end a document. The model's symbols are the commonest words, classes
of the other words by their last letters, and the end; a word of a class has, given the class, the share of
its count (plus a half) in the class, in which unseen words hold one half. So the model gives every sequence
of tokens a probability, and the likelihood of a text is that of its symbols, by the forward recursion,
times those shares.

Counts are over all training documents, and so are the Baum-Welch passes. The first parameters come from
the counts of pairs of neighbouring symbols among the ``PAIRS`` commonest, over all training documents,
by expectation-maximisation on that bounded matrix.

What is held in one place is bounded by parameters: ``KNOWN`` words whose counts every task gets,
``SYMBOLS`` times ``states`` numbers. Rarer words are joined with the count table by a shuffle.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, fold, lower_words, prepare, written

END = ""                 # no word is empty
#: Words whose counts go to every task; the others are joined.
KNOWN = 200_000
#: Symbols of the model: this many words, then classes, then the end.
WORDS, CLASSES = 60_000, 5_000
SYMBOLS = WORDS + CLASSES + 1
PAIRS = 1_000
#: Distinct words that a counting task holds before it sends their counts on.
COUNTED = 300_000
#: Tokens of the sequences that run through the recursions together.
TOGETHER = 400_000


def word_class(word: bytes) -> int:
    """A class by the last three bytes and whether the word is short."""
    return zlib.crc32(word[-3:] + (b"+" if len(word) > 5 else b"-")) % CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """(w, c): the tokens of docs and their counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            f = pd.DataFrame({"w": [w.decode("utf-8", "surrogatepass") for w in held], "c": list(held.values())})
            held.clear()
            return f
        for pdf in batches:
            for t in clean(pdf["text"]):
                held.update(lower_words(t))
                held[b""] += 1
                if len(held) > COUNTED:
                    yield out()
        if held:
            yield out()
    return docs.select("text").mapInPandas(run, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows of the counts; bounded by KNOWN and CLASSES."""
    counts: dict[bytes, int]         # of the KNOWN commonest words at most
    symbol: dict[bytes, int]         # of the WORDS commonest
    mass: np.ndarray                 # of each symbol: its counts plus a half for each word, and for unseen ones
    total: int                       # N
    distinct: int                    # V
    end: int                         # the count of ends

    @property
    def log_denominator(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written count table."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = counts.where("w != ''")
    # The least count that at most KNOWN words reach, from a histogram of counts (powers of 2^(1/8)).
    steps = {r["k"]: r["n"] for r in words.groupBy(F.floor(F.log2("c") * 8).alias("k")).agg(F.count("*").alias("n")).collect()}
    reach, least = 0, None
    for k in sorted(steps, reverse=True):
        reach += steps[k]
        if reach > KNOWN:
            break
        least = k
    found = [] if least is None else words.where(F.floor(F.log2("c") * 8) >= least).collect()
    found = sorted(((r["w"].encode("utf-8", "surrogatepass"), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))
    known = dict(found)
    symbol = {w: i for i, (w, _) in enumerate(found[:WORDS])}
    mass = np.zeros(SYMBOLS)
    for w, i in symbol.items():
        mass[i] = known[w] + 0.5
    mass[WORDS:] = 0.5
    end = counts.where("w = ''").first()
    mass[-1] = (end["c"] if end else 0) + 0.5

    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ws = [w.encode("utf-8", "surrogatepass") for w in pdf["w"]]
            f = pd.DataFrame({"k": [-1 if w in symbol else word_class(w) for w in ws], "m": pdf["c"].to_numpy() + 0.5})
            yield f[f.k >= 0].groupby("k", as_index=False).sum()
    for r in words.mapInPandas(classes, "k int, m double").groupBy("k").agg(F.sum("m").alias("m")).collect():
        mass[WORDS + r["k"]] += r["m"]
    return Vocabulary(known, symbol, mass, total, distinct, end["c"] if end else 0)


class _Numbers(dict):
    """Word to number: the known words, the end, then the other words as they come (``others``)."""

    def __init__(self, v: Vocabulary):
        super().__init__((w, i) for i, w in enumerate(v.counts))
        self[END.encode()] = self.known = len(v.counts)
        self.others: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.known + 1 + len(self.others)
        self.others.append(word)
        return n

    def forget(self) -> None:
        for w in self.others:
            del self[w]
        self.others = []


def encoded(docs: DataFrame, v: Vocabulary, mod: int) -> DataFrame:
    """One row for each row of docs: its symbols, what the known words add to the scores, and its other words.

    A batch's words become numbers by one dictionary; all sums are over arrays that the numbers index.
    """
    share = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = share.value
        n = TaskContext.get().partitionId() << 40
        number, log_mass = _Numbers(v), np.log10(v.mass)
        symbol = np.fromiter((v.symbol[w] if w in v.symbol else WORDS + word_class(w) for w in v.counts), np.int64, len(v.counts))
        base = np.log10(np.fromiter(v.counts.values(), np.float64, len(v.counts)) + 0.5)
        in_class = symbol >= WORDS
        inside = np.append(np.where(in_class, base - log_mass[symbol], 0.0), 0.0)
        base, symbol = np.append(base, math.log10(v.end + 0.5)), np.append(symbol, SYMBOLS - 1)
        for pdf in batches:
            doc_ids = clean(pdf["doc_id"])
            ids, lengths = [], []
            for text in clean(pdf["text"]):
                ws = lower_words(text)
                ws.append(END.encode())
                ids.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
                lengths.append(len(ws))
            if not ids:
                continue
            flat, at = np.concatenate(ids), np.concatenate([[0], np.cumsum(lengths)])
            classes = np.fromiter((WORDS + word_class(w) for w in number.others), np.int64, len(number.others))
            symbols = np.concatenate([symbol, classes])[flat].astype("<u2" if SYMBOLS <= 65536 else "<u4")
            base_sum = np.add.reduceat(np.concatenate([base, np.zeros(len(classes))])[flat], at[:-1])
            inside_sum = np.add.reduceat(np.concatenate([inside, -log_mass[classes]])[flat], at[:-1])
            other = flat > number.known
            others = np.add.reduceat(other, at[:-1], dtype=np.int64)
            rows = []
            for i, doc in enumerate(doc_ids):
                lo, hi = at[i], at[i + 1]
                tail = []
                if others[i]:
                    which, tf = np.unique(flat[lo:hi][other[lo:hi]], return_counts=True)
                    tail = [{"w": number.others[w].decode("utf-8", "surrogatepass"), "tf": k}
                            for w, k in zip((which - number.known - 1).tolist(), tf.tolist())]
                rows.append((n, doc, fold(doc, mod) == 1, lengths[i], base_sum[i], inside_sum[i],
                             lengths[i] - 1 - int(others[i]) + (v.end > 0), symbols[lo:hi].tobytes(), tail))
                n += 1
            if len(number.others) > COUNTED:
                number.forget()
            yield pd.DataFrame(rows, columns=["row_id", "doc_id", "held_out", "n_tokens", "base", "inside", "known",
                                              "symbols", "tail"]).astype({"doc_id": "Int64"})
    return docs.mapInPandas(run, "row_id long, doc_id long, held_out boolean, n_tokens long, base double, inside double, "
                                 "known long, symbols binary, tail array<struct<w: string, tf: long>>")


@dataclass
class Hmm:
    start: np.ndarray          # states
    move: np.ndarray           # states x states
    emit: np.ndarray           # symbols x states


def _sequences(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    held, n, frames = [], 0, []
    for pdf in batches:
        lo = 0
        seqs = [np.frombuffer(b, "<u2" if SYMBOLS <= 65536 else "<u4") for b in pdf["symbols"]]
        for i, s in enumerate(seqs):
            held.append(s)
            n += len(s)
            if n >= TOGETHER:
                yield pd.concat([*frames, pdf.iloc[lo:i + 1]]), held
                held, n, frames, lo = [], 0, [], i + 1
        if lo < len(pdf):
            frames.append(pdf.iloc[lo:])
    if held:
        yield pd.concat(frames), held


def _time_major(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols by time, longest sequence first: order, the symbols, the starts of the times, how many sequences
    are alive at each."""
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    lengths = np.array([len(seqs[i]) for i in order])
    alive = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
    at = np.concatenate([[0], np.cumsum(alive)])
    flat = np.empty(at[-1], np.int64)
    for row, i in enumerate(order):
        flat[at[:len(seqs[i])] + row] = seqs[i]
    return order, flat, at, alive


def forward(m: Hmm, flat: np.ndarray, at: np.ndarray, alive: np.ndarray, keep: bool):
    """Log likelihood of each sequence (in time-major order); if keep, also scaled alphas and scales."""
    k = len(m.start)
    alphas = np.empty((len(flat), k)) if keep else None
    scales, ones = np.empty(len(flat)), np.ones(k)
    a = None
    for t in range(len(alive)):
        lo, hi = at[t], at[t + 1]
        e = m.emit.take(flat[lo:hi], axis=0)
        if t == 0:
            e *= m.start
        else:
            e *= a[:hi - lo] @ m.move
        c = e @ ones
        e /= c[:, None]
        a = e
        scales[lo:hi] = c
        if keep:
            alphas[lo:hi] = a
    # A sequence's logs are added in the order of time, all sequences at once.
    row = np.arange(len(flat)) - np.repeat(at[:-1], alive)
    like = np.bincount(row, np.log(scales), alive[0])
    return like, alphas, scales


def expected(m: Hmm, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of these sequences: starts, moves, emissions."""
    _, flat, at, alive = _time_major(seqs)
    _, alphas, scales = forward(m, flat, at, alive, True)
    k = len(m.start)
    gamma = np.empty_like(alphas)
    moves = np.zeros((k, k))
    b, back = None, np.ascontiguousarray(m.move.T)
    for t in range(len(alive) - 1, -1, -1):
        lo, hi = at[t], at[t + 1]
        b_now = m.emit.take(flat[lo:hi], axis=0)
        b_now /= scales[lo:hi, None]
        gamma[lo:hi] = alphas[lo:hi]
        if b is not None and len(b):
            beta = b @ back
            moves += alphas[lo:lo + len(b)].T @ b
            gamma[lo:lo + len(b)] *= beta
            b_now[:len(b)] *= beta
        b = b_now
    emits = np.stack([np.bincount(flat, gamma[:, j], SYMBOLS) for j in range(k)], axis=1)
    return gamma[:alive[0]].sum(axis=0), moves * m.move, emits


def pair_counts(train: DataFrame) -> np.ndarray:
    """Counts of neighbouring symbols among the PAIRS commonest words, over all of train."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = np.zeros(PAIRS * PAIRS, np.int64)
        for _, seqs in _sequences(batches):
            for s in (x.astype(np.int64) for x in seqs):
                ok = (s[:-1] < PAIRS) & (s[1:] < PAIRS)
                np.add.at(c, s[:-1][ok] * PAIRS + s[1:][ok], 1)
        at = np.flatnonzero(c)
        yield pd.DataFrame({"ij": at, "c": c[at]})
    found = train.select("symbols").mapInPandas(run, "ij long, c long").groupBy("ij").agg(F.sum("c").alias("c")).toPandas()
    c = np.zeros(PAIRS * PAIRS)
    c[found["ij"].to_numpy(np.int64)] = found["c"]
    return c.reshape(PAIRS, PAIRS)


def first_model(pairs: np.ndarray, mass: np.ndarray, states: int, rounds: int = 80, seed: int = 5) -> Hmm:
    """Parameters that explain the pair counts: P(i, j) = sum over z, z' of T[z, z'] B[z, i] B[z', j]."""
    rng = np.random.default_rng(seed)
    share = mass / mass.sum()
    b = rng.dirichlet(np.ones(PAIRS) * 0.5, states) * 0.5 + 0.5 * (pairs.sum(0) + 1) / (pairs.sum() + PAIRS)
    b /= b.sum(axis=1, keepdims=True)
    t = (np.eye(states) * states + 1) / (2 * states * states)
    if pairs.sum():
        c = pairs / pairs.sum()
        for _ in range(rounds):
            ratio = c / np.maximum(b.T @ t @ b, 1e-300)
            left, right = b @ ratio, ratio @ b.T
            new_t = t * (left @ b.T)
            new_b = b * (t @ (right.T) + t.T @ left)
            t = new_t / new_t.sum()
            b = new_b / np.maximum(new_b.sum(axis=1, keepdims=True), 1e-300)
    weight = t.sum(axis=0) + 1e-6
    emit = np.tile(share[:, None], (1, states))
    inside = share[:PAIRS].sum()
    emit[:PAIRS] = (0.95 * b.T + 0.05 * share[:PAIRS, None] / max(inside, 1e-300)) * inside
    emit /= emit.sum(axis=0)
    move = t + 1e-6
    return Hmm(weight / weight.sum(), move / move.sum(axis=1, keepdims=True), emit)


def baum_welch(train: DataFrame, m: Hmm, mass: np.ndarray) -> Hmm:
    """One pass over all of train: counts are summed in Spark, SYMBOLS x states numbers come back."""
    states = len(m.start)
    share = train.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = share.value
        start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((SYMBOLS, states))
        for _, seqs in _sequences(batches):
            s, v, e = expected(m, seqs)
            start, moves, emits = start + s, moves + v, emits + e
        rows = np.vstack([emits, moves, start[None, :]])
        at = np.flatnonzero(rows.any(axis=1))
        yield pd.DataFrame(rows[at], columns=[f"s{j}" for j in range(states)]).assign(at=at)
    cols = ", ".join(f"s{j} double" for j in range(states))
    found = (train.select("symbols").mapInPandas(run, f"{cols}, at long").groupBy("at")
             .agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(states)]).toPandas())
    rows = np.zeros((SYMBOLS + states + 1, states))
    rows[found["at"].to_numpy(np.int64)] = found[[f"s{j}" for j in range(states)]]
    emits, moves, start = rows[:SYMBOLS], rows[SYMBOLS:-1], rows[-1]
    # A little of the unigram shares goes into each state, so that no symbol has probability zero.
    prior = 0.002 * emits.sum(axis=0) + 1.0
    emits = emits + mass[:, None] / mass.sum() * prior
    moves, start = moves + 0.1, start + 0.1
    return Hmm(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def score_texts(docs: DataFrame, states: int = 8, passes: int = 2, mod: int = 5) -> DataFrame:
    """Scores each row of docs (doc_id, text; other columns are ignored), learning from those whose
    crc32(doc_id as text) mod ``mod`` is not 1.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); the scores are log10
    probabilities. A null or empty text is the end alone. A null doc_id counts as the empty text in the
    fold, so it is a training row; rows that share a doc_id are separate documents. Without training rows
    every word is unseen; without any rows there is no result.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    in_training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod != 1
    counts = written(count_words(docs.where(in_training)), "counts")
    v = vocabulary(counts)
    rows = written(encoded(docs, v, mod), "encoded")
    train = rows.where("not held_out")
    m = first_model(pair_counts(train), v.mass, states)
    for _ in range(passes):
        m = baum_welch(train, m, v.mass)
    share = docs.sparkSession.sparkContext.broadcast(m)

    def likelihood(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, seqs in _sequences(batches):
            order, flat, at, alive = _time_major(seqs)
            like, _, _ = forward(share.value, flat, at, alive, False)
            out = np.empty(len(seqs))
            out[order] = like / math.log(10)
            yield pdf.drop(columns="symbols").assign(hmm=out)
    light = ["row_id", "doc_id", "held_out", "n_tokens", "base", "inside", "known"]
    own = rows.select(*light, "symbols").mapInPandas(
        likelihood, "row_id long, doc_id long, held_out boolean, n_tokens long, base double, inside double, known long, hmm double")
    tail = (rows.select("row_id", F.explode("tail").alias("x")).select("row_id", F.col("x.w").alias("w"), F.col("x.tf").alias("tf"))
            .join(counts, "w", "left").groupBy("row_id")
            .agg(F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare"),
                 F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known")))
    rare = F.coalesce("rare", F.lit(0.0))
    return own.join(tail, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(v.total)).cast("long").alias("train_tokens"),
        (F.col("base") + rare - F.col("n_tokens") * v.log_denominator).alias("base_score"),
        (F.col("hmm") + F.col("inside") + rare).alias("score"))
