"""Substring dedup by level-wise doubling.

A window is ``window`` consecutive words of one document; every word covered by a window whose word
sequence also starts anywhere else goes. Levels are a quarter, a half and the whole of the window
(9, 18, 35 words): only what is repeated at one length is extended to twice that length.

At the first level not every position is sent. Each full window is represented by the leftmost of
its smallest 9-word hashes (its anchor). Equal windows have their anchors at the same place, so a
window that is repeated has an anchor whose nine words are repeated as an anchor; positions that are
no window's anchor need no row. At the second level an anchor is extended to 18 words, to the right
for windows in which 18 words from the anchor on fit, else to the left. At the last level each window
of a surviving anchor is compared as a whole, by 96 hash bits.

A key's rows are thinned before the shuffle: rows of a batch that repeat inside that batch are known to
survive, go to any task, and leave one marker under their key. So a passage that a third of all
documents share doesn't gather in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, free_names, prepare, tidy, words, written

U = np.uint64
WINDOW = 35
#: Light rows that a task puts together before it looks for repeats among them.
GATHER = 200_000
#: Words of a batch whose hashes are held at once (a text is never cut).
WORDS_AT_ONCE = 400_000


def mix(left: np.ndarray, right: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of a sequence from those of its two parts."""
    x = left * U(0x9E3779B97F4A7C15 + 2 * salt) ^ (left >> U(29))
    x = (x + right) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(31))


def word_hashes(ws: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, ws), U, len(ws))


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, from those of single words, by doubling."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, U)
    level, size = h, 1
    while size * 2 <= length:
        level = mix(level[:len(level) - size], level[size:])
        size *= 2
    if size < length:                      # the last step overlaps itself
        level = mix(level[:n], level[length - size:length - size + n], 1)
    return level


def leftmost_least(h: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` values, the position of the leftmost smallest."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, size = np.arange(len(h)), 1
    while size * 2 <= span:
        a, b = at[:len(at) - size], at[size:]
        at = np.where(h[a] <= h[b], a, b)
        size *= 2
    if size < span:
        a, b = at[:n], at[span - size:span - size + n]
        at = np.where(h[a] <= h[b], a, b)
    return at


class Levels:
    """Hashes of the levels over the words of several documents in one array."""

    def __init__(self, texts: list[list[bytes]], window: int):
        self.quarter, self.window = -(-window // 4), window
        self.half = min(2 * self.quarter, window)
        lengths = np.array([len(x) for x in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        self.doc = np.repeat(np.arange(len(texts)), lengths)
        self.words = word_hashes([w for x in texts for w in x])
        self.h_quarter = doubled(self.words, self.quarter)
        n = max(0, len(self.words) - window + 1)
        self.starts = np.flatnonzero(self.doc[:n] == self.doc[window - 1:]) if n else np.empty(0, np.int64)
        anchor = leftmost_least(self.h_quarter, window - self.quarter + 1)
        self.anchor = anchor[self.starts] if n else self.starts     # of each window
        #: The side to which a window's anchor is extended: right (0) if the half length fits in the window.
        self.side = (self.anchor - self.starts > window - self.half).astype(np.int8)

    def halves(self) -> tuple[np.ndarray, ...]:
        """(anchor, has a window extended to the right, to the left, hash to the right, hash to the left)."""
        h_half = doubled(self.words, self.half)
        a = np.unique(self.anchor)
        right, left = np.isin(a, self.anchor[self.side == 0]), np.isin(a, self.anchor[self.side == 1])
        back = self.half - self.quarter
        to = np.zeros(len(a), U)
        to[right] = h_half[a[right]]
        fro = np.zeros(len(a), U)
        fro[left] = h_half[a[left] - back]
        return a, right, left, to, fro

    def wholes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = doubled(self.words, self.window)[starts]
        other = mix(doubled(self.words, self.half)[starts], self.words[starts + self.window - 1], 5)
        return whole, (other >> U(33)).astype(np.int64)


def key_of(col):
    """124 bits of a text, as two longs; never null, for in pandas a null would turn the others into floats."""
    low = F.conv(F.substring(F.md5(F.col(col).cast("binary")), 1, 15), 16, 10).cast("long")
    return [F.xxhash64(col).alias("k1"), F.coalesce(low, F.lit(0)).alias("k2")]


def in_groups(batches: Iterator[pd.DataFrame], col: str = "text") -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Parts of the batches with their words, of bounded size but for single long texts."""
    for pdf in batches:
        held, lo, total = [], 0, 0
        for i, text in enumerate(clean(pdf[col])):
            ws = words(text)
            if total and total + len(ws) > WORDS_AT_ONCE:
                yield pdf.iloc[lo:i], held
                held, lo, total = [], i, 0
            held.append(ws)
            total += len(ws)
        if held:
            yield pdf.iloc[lo:], held


# ------------------------------------------------------------------ rows whose key is not alone

def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= GATHER:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Steps:
    """Rows that ``fn`` makes of ``df``'s Arrow batches. What follows on them in the same task goes on in the same Python
    worker: a second worker for each core would hold its own memory, and live on with it."""
    df: DataFrame
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
    types: dict[str, str]

    def then(self, fn, types: dict[str, str]) -> Steps:
        first = self.fn
        return Steps(self.df, lambda batches: fn(first(batches)), types)

    def frame(self) -> DataFrame:
        return self.df.mapInArrow(tidy(self.fn), _ddl(self.types))


def _ddl(types: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in types.items())


def _schema(types: dict[str, str]) -> pa.Schema:
    return pa.schema([(c, {"long": pa.int64(), "int": pa.int32()}[t]) for c, t in types.items()])


def from_pandas(fn, types: dict[str, str]):
    """A function of pandas batches as one of Arrow batches."""
    schema = _schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pdf in fn(b.to_pandas() for b in batches):
            yield pa.RecordBatch.from_pandas(pdf, schema=schema, preserve_index=False)
    return run


def repeated(rows: Steps, key: str, half: str | None = None) -> Steps:
    """Of the rows whose key (a long column) some other row also has, the other columns. The upper 32 bits of the long
    column ``half``, if there is one, belong to the key, too; its lower bits come back as an int. That saves a column of the shuffle."""
    names = [c for c in rows.types if c != key]
    low = (1 << 32) - 1

    def arrays(t: pa.Table) -> list[np.ndarray]:
        return [t.column(key).to_numpy()] + ([t.column(half).to_numpy() >> 32] if half else [])

    def order(cols: list[np.ndarray]) -> np.ndarray:
        return np.lexsort(cols[::-1])

    def equal_next(cols: list[np.ndarray]) -> np.ndarray:
        same = np.ones(max(0, len(cols[0]) - 1), bool)
        for c in cols:
            same &= c[1:] == c[:-1]
        return same

    def thin(batches):
        """kind 0: alone in this batch; 1: known to be repeated; 2: a marker for kind 1."""
        for t in _gathered(batches):
            if not t.num_rows:
                continue
            at = order(cols := arrays(t))
            same = equal_next([c[at] for c in cols])
            first = np.concatenate([[True], ~same])
            alone = first & np.concatenate([~same, [True]])
            kind = np.where(alone, 0, 1).astype(np.int8)
            t = t.take(pa.array(at))
            mark = t.take(pa.array(np.flatnonzero(first & ~alone)))
            # Rows that are known to be repeated need their key no more.
            for c, kept in [(key, 0)] + ([(half, low)] if half else []):
                v = t.column(c).to_numpy().copy()
                v[~alone] &= kept
                i = t.schema.get_field_index(c)
                t = t.set_column(i, t.schema.field(i), pa.array(v))
            yield from t.append_column("kind", pa.array(kind)).to_batches()
            if mark.num_rows:
                yield from mark.append_column("kind", pa.array(np.full(mark.num_rows, 2, np.int8))).to_batches()

    def check(batches):
        """Rows sorted by key: of the last key, at most one row waits for the next batch."""
        wait, last, seen = None, None, False
        for t in _gathered(batches):
            kind = t.column("kind").to_numpy()
            sure = t.filter(pa.array(kind == 1)).select(names)
            if sure.num_rows:
                yield from sure.to_batches()
            t = t.filter(pa.array(kind != 1))
            if not t.num_rows:
                continue
            kind, cols = t.column("kind").to_numpy(), arrays(t)
            same = equal_next(cols)
            many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            firsts, lasts = tuple(int(c[0]) for c in cols), tuple(int(c[-1]) for c in cols)
            if last == firsts:
                if wait is not None:
                    yield from wait.to_batches()
                n = len(many) if same.all() else int(np.argmin(same)) + 1
                many[:n] = True
            elif wait is not None:
                wait = None
            seen = bool(many[-1])
            wait, last = None, lasts
            keep = many & (kind == 0)
            if keep.any():
                yield from t.filter(pa.array(keep)).select(names).to_batches()
            if not seen and kind[-1] == 0:
                wait = t.slice(t.num_rows - 1).select(names)

    def lower(batches):
        for b in batches:
            i = b.schema.get_field_index(half)
            b = b.set_column(i, half, pa.array((b.column(i).to_numpy() & low).astype(np.int32)))
            yield b
    thinned = rows.then(thin, rows.types | {"kind": "tinyint"}).frame()
    deal = F.when(F.col("kind") == 1, F.xxhash64(*names)).otherwise(F.col(key))
    left = {c: rows.types[c] for c in names}
    dealt = thinned.repartition(deal).sortWithinPartitions(key, *([half] if half else []))
    found = Steps(dealt, check, left)
    return found.then(lower, left | {half: "int"}) if half else found


# ------------------------------------------------------------------ the operator

def _anchors(texts: DataFrame, window: int) -> Steps:
    """(h, to_right, to_left, k1, place): one row for each anchor of a document; place is four times its word's place, and 1 for
    windows to the right, 2 for those to the left. k1 alone names the text here: if two texts share it, each gets the other's
    candidates too, and the last level sorts them out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, ws in in_groups(batches):
            v = Levels(ws, window)
            if not len(v.starts):
                continue
            a, right, left, to, fro = v.halves()
            d = v.doc[a]
            yield pd.DataFrame({"h": v.h_quarter[a].view(np.int64), "to_right": to.view(np.int64), "to_left": fro.view(np.int64),
                                "k1": pdf["k1"].to_numpy()[d], "place": 4 * (a - v.begins[d]) + right + 2 * left})
    types = {"h": "long", "to_right": "long", "to_left": "long", "k1": "long", "place": "long"}
    return Steps(texts, from_pandas(run, types), types)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, k1, mark) of the half windows of surviving anchors, to the right and to the left; mark is twice the anchor's place,
    and 1 more for those to the left."""
    for b in batches:
        place, k1 = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("place", "k1"))
        for side, c in enumerate(("to_right", "to_left")):
            at = np.flatnonzero(place >> side & 1)
            h = b.column(b.schema.get_field_index(c)).to_numpy()[at].view(U)
            cols = mix(h, np.full(len(h), side, U), 7).view(np.int64), k1[at], ((place[at] >> 2) * 2 + side).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["h", "k1", "mark"])


def _last_level(cand: DataFrame, window: int) -> Steps:
    """(h, at, id): every window of a surviving anchor, by its whole hash: h and the upper half of at, whose lower half is
    the window's start."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, ws in in_groups(batches):
            v = Levels(ws, window)
            alive = np.zeros((2, len(v.words) + 1), bool)
            for i, (marks, begin) in enumerate(zip(pdf["marks"], v.begins)):
                m = np.asarray(marks, np.int64)
                alive[m & 1, begin + (m >> 1)] = True
            ok = alive[v.side, v.anchor] if len(v.starts) else np.empty(0, bool)
            s = v.starts[ok]
            if len(s):
                whole, other = v.wholes(s)
                d = v.doc[s]
                yield pd.DataFrame({"h": whole.view(np.int64), "at": (other << 32) + s - v.begins[d], "id": pdf["id"].to_numpy()[d]})
    types = {"h": "long", "at": "long", "id": "long"}
    return Steps(cand, from_pandas(run, types), types)


def changes(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """What goes, by text, as two tables in the shared folder.

    copies (k1, k2, copies, chosen): texts that occur more than once. With ``window`` words or more, such a
    text goes as a whole. changed (k1, k2, n_removed, kept_text): texts that occur once and lose words.
    k1 and k2 are the text's key, see key_of().
    """
    prepare(docs.sparkSession)
    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null") \
        .select("doc_id", "text", *key_of("text"))
    copies = keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("chosen"))
    copies = written(copies.where("copies > 1"), "copies")

    first = repeated(_anchors(keyed.select("k1", "text"), window), "h")
    sides = first.then(_sides, {"h": "long", "k1": "long", "mark": "int"})
    second = repeated(sides, "h").frame().groupBy("k1").agg(F.collect_set("mark").alias("marks"))
    # Of equal texts one goes on: its windows are repeated for certain, and stand for the others.
    same = copies.groupBy("k1").agg(F.collect_list(F.struct("k2", "chosen")).alias("same"))
    alive = second.join(same, "k1", "left")
    copied = F.filter(F.coalesce("same", F.array().cast("array<struct<k2: bigint, chosen: bigint>>")), lambda c: c["k2"] == F.col("k2"))
    cand = (keyed.join(alive, "k1").withColumn("of", copied)
            .where((F.size("of") == 0) | F.exists("of", lambda c: c["chosen"].eqNullSafe(F.col("doc_id"))))
            .select("k1", "k2", "text", "marks", (F.size("of") > 0).alias("whole")))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, part = 0, TaskContext.get().partitionId()
        for b in batches:
            ids = pa.array((np.arange(n, n + b.num_rows) << 22) + part)      # row, partition: ids of few bytes
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([ids, *b.columns], ["id", *b.schema.names])
    cand = written(cand.mapInArrow(numbered, "id long, k1 long, k2 long, text string, marks array<int>, whole boolean"), "texts")
    covered = repeated(_last_level(cand, window), "h", "at").frame().groupBy("id").agg(F.collect_list("at").alias("starts"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, starts in zip(pdf["text"], pdf["starts"]):
                ws = words(text)
                edge = np.zeros(len(ws) + 1, np.int64)
                s = np.asarray(starts, np.int64)
                np.add.at(edge, s, 1)
                np.add.at(edge, s + window, -1)
                left = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                out.append((len(ws) - len(left), joined([ws[i] for i in left])))
            yield pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], "n_removed": [x[0] for x in out], "kept_text": [x[1] for x in out]})
    changed = (cand.where("not whole").join(covered, "id").select("k1", "k2", "text", "starts")
               .mapInPandas(tidy(keep), "k1 long, k2 long, n_removed long, kept_text string"))
    # A repeated row (same doc_id, same text) is a copy, so a key has one changed row at most.
    return copies, written(changed, "changed")


def joined(ws: list[bytes]) -> str:
    return b" ".join(ws).decode("utf-8", "surrogatepass")


def word_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row: what substring dedup does to it.

    Null and empty texts have no words; texts of fewer than ``window`` words lose none. Rows that share a
    doc_id or a text get one row each. An empty table gives no rows. Other columns are ignored.
    """
    copies, changed = changes(docs, window)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ws = [words(t) for t in clean(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "k1": pdf["k1"], "k2": pdf["k2"], "n_words": [len(x) for x in ws],
                                "own": [hashlib.sha256(b" ".join(x)).digest() for x in ws]})
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .select("doc_id", "text", *key_of("text")).mapInPandas(tidy(own), "doc_id long, k1 long, k2 long, n_words long, own binary"))
    gone = F.col("copies").isNotNull() & (F.col("n_words") >= window)
    return (rows.join(copies.select("k1", "k2", "copies"), ["k1", "k2"], "left")
            .join(changed.select("k1", "k2", "n_removed", F.unhex(F.sha2(F.col("kept_text").cast("binary"), 256)).alias("sha")), ["k1", "k2"], "left")
            .select("doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.lower(F.hex(F.coalesce("sha", "own")))).alias("kept_sha256")))


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs with repeated words taken out of text; n_chars, if there is one, follows the text, and all other
    columns are unchanged.

    A text that loses words becomes its kept words joined by one space (the empty text if none is kept);
    any other text, null included, stays as it is. No row goes.
    """
    copies, changed = changes(docs, window)
    a, b, n1, n2, kept = free_names(docs, "a", "b", "n1", "n2", "kept")

    def empty(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[len(words(t)) >= window for t in pdf["text"]]][["k1", "k2"]]
    # Which of the copied texts are long enough is asked of one copy each.
    gone = (docs.select("doc_id", F.col("text").cast("string").alias("text")).select("doc_id", "text", *key_of("text"))
            .join(copies, ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("chosen"))).select("k1", "k2", "text")
            .mapInPandas(tidy(empty), "k1 long, k2 long").distinct().select("k1", "k2", F.lit("").alias("kept_text")))
    new = changed.select("k1", "k2", "kept_text").unionByName(gone) \
        .select(F.col("k1").alias(n1), F.col("k2").alias(n2), F.col("kept_text").alias(kept))
    k1, k2 = key_of("text")
    return (docs.withColumn(a, k1).withColumn(b, k2)
            .join(new, (F.col(a) == F.col(n1)) & (F.col(b) == F.col(n2)), "left")
            .withColumn("text", F.coalesce(kept, "text"))
            .withColumns({"n_chars": F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType)}
                         if "n_chars" in docs.columns else {}).select(*[F.col(f"`{c}`") for c in docs.columns]))
