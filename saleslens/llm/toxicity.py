"""Toxicity by a subsequence string kernel, Nystrom landmarks and a support vector machine.

The kernel compares two words by the subsequences of three to six letters they share (the start of a word
counts as a letter), each weighted by DECAY to the power of the letters it skips, at most ``SKIPS``. So an
inserted letter or sign lowers the likeness a little and doesn't break it. A machine over Nystrom features of that kernel
is linear in the subsequences, so it is stored as one weight a subsequence and words are scored in arrays.

Labels mark documents, and one word in hundreds makes a document toxic. The machine is therefore
trained on witnesses: at first the words of a toxic document that most tell it from clean ones, then the
words the machine itself finds there, against words of clean documents, in which it looks for its own
worst errors. A document is scored by its three highest words, calibrated on labelled documents that the
machine wasn't trained on.

The fit takes a bounded sample (``SAMPLE`` labelled documents of each class, chosen by a hash of their id).
Every document is scored over its whole text.
"""

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, fold_column, prepare, tidy, trim, worker_cache, written

#: Word parts whose subsequences are held at once.
RAW = 2_000
#: Words or runs that a task counts before it hands the counts on, so that a document's row for each isn't held.
COUNTED = 100_000
#: Labelled documents that the fit reads, by label: clean words are told from toxic ones by clean documents, so more of those.
SAMPLE = {0: 3500, 1: 1400}
#: Words of clean documents that train the machine, besides those it gets wrong.
NEGATIVES, HARD = 8000, 2000
LANDMARKS = 160          # of each class
#: Words of one toxic document that count as witnesses at first, and the least that their letters must tell.
WITNESSES, LEAST = 4, 8.0
DECAY = 0.85             # for each letter skipped
LONGEST = 40             # letters; longer words are compared in overlapping parts
#: Characters of texts whose words are held at once; a longer text is taken alone.
AT_ONCE = 500_000
#: Words whose scores a worker keeps.
REMEMBERED = 500_000
TOP = 3
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_][^\w\s]{0,2}\s){2,}[^\W\d_][^\w\s]{0,2}(?!\S)")
#: Lengths of the subsequences, and the letters that each may skip.
SKIPS = {3: 2, 4: 2, 5: 1, 6: 1}
_STEP = np.uint64(0x100000001B3 * 0x9E3779B1 % 2 ** 64)
_OFFSETS = [(0, *rest) for p, skip in SKIPS.items() for rest in itertools.combinations(range(1, p + skip), p - 1)]


def units(text: str | None) -> set[str]:
    """The distinct words of a text in lower case, and runs of three or more single letters as one word."""
    if not text:
        return set()
    low = text.lower()
    found = set(low.split())
    found.update("".join(re.findall(r"[^\W\d_]", m.group())) for m in _SPELLED.finditer(low))
    return found


def letters(word: str) -> str:
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


def _places(words: list[str]) -> Iterator[tuple[tuple[int, ...], np.ndarray, np.ndarray]]:
    """(letters' offsets, places of each word, codes) of each form of subsequence: a row of codes for each word, of which
    its places come first. Forms that begin alike share their beginning."""
    marked = [f"^{w}" for w in words]
    n = np.array([len(w) for w in marked], np.int64)
    longest = int(n.max(initial=1))
    chars = np.zeros((len(marked), longest), np.uint64)
    flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(marked)), n)
    chars[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    chars += np.uint64(1)
    begun: dict[tuple[int, ...], np.ndarray] = {}
    for off in _OFFSETS:
        wide = longest - off[-1]
        if wide < 1:
            continue
        if (len(off),) not in begun:
            begun = {(len(off),): np.full(chars.shape, len(off), np.uint64)}
        for k in range(1, len(off) + 1):
            key = (len(off), *off[:k])
            if key not in begun:
                before, o = begun[key[:-1]], off[k - 1]
                code = before[:, :longest - o] * _STEP
                code += chars[:, o:]
                begun[key] = code
        yield off, np.maximum(n - off[-1], 0), begun.pop((len(off), *off))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, value): the kernel's feature vectors, one entry for each place of a subsequence; entries of one code add up."""
    at_row, codes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0)]
    for off, n, code in _places(words):
        at_row.append(np.repeat(np.arange(len(words)), n))
        codes.append(code[np.arange(code.shape[1]) < n[:, None]])
        values.append(np.full(len(codes[-1]), DECAY ** (off[-1] + 1 - len(off))))
    r, code, val = np.concatenate(at_row), np.concatenate(codes), np.concatenate(values)
    # A word's length, of sorts: any positive number by which a kernel's features are divided leaves it a kernel.
    norm = np.sqrt(np.bincount(r, val * val, len(words)))
    return r, code, val / norm[r]


def _norms() -> np.ndarray:
    """What subsequences() divides the values of a word by, by its number of letters up to LONGEST."""
    out = np.ones(LONGEST + 1)
    for n in range(LONGEST + 1):
        v = [DECAY ** (off[-1] + 1 - len(off)) for off in _OFFSETS for _ in range(n + 1 - off[-1])]
        if v:
            out[n] = np.sqrt(np.bincount(np.zeros(len(v), np.int64), np.array(v) * np.array(v)))[0]
    return out


def parts(word: str) -> list[str]:
    w = letters(word)
    return [w] if len(w) <= LONGEST else [w[i:i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2)]


_NORMS = _norms()


class Weights:
    """Codes to weights: tables addressed by some bits of a code; a code whose place is taken goes to the next table."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        self.tables = []
        turn = _STEP
        while len(codes):
            bits = min(20, max(8, int(16 * len(codes)).bit_length()))
            shift = np.uint64(64 - bits)
            slot = ((codes * turn) >> shift).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key, value = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits)
            key[slot[first]], value[slot[first]] = codes[first], weights[first]
            self.tables.append((turn, shift, key, value))
            rest = np.ones(len(codes), bool)
            rest[first] = False
            codes, weights, turn = codes[rest], weights[rest], np.uint64(int(turn) * int(_STEP) % 2 ** 64)

    def found(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of code that have a weight, their weights), places in ascending order."""
        at, weight = [np.zeros(0, np.int64)], [np.zeros(0)]
        for turn, shift, key, value in self.tables:
            slot = code * turn
            slot >>= shift
            slot = slot.view(np.int64)
            hit = np.flatnonzero(key[slot] == code)
            at.append(hit)
            weight.append(value[slot[hit]])
        at, weight = np.concatenate(at), np.concatenate(weight)
        order = np.argsort(at, kind="stable")
        return at[order], weight[order]


@dataclass
class Model:
    codes: np.ndarray
    weights: np.ndarray
    bias: float
    calibration: np.ndarray      # of (1, highest, mean of the TOP highest)

    def __getstate__(self):
        """Without the tables, which each worker builds for itself: they are many times as large as the weights."""
        return {k: v for k, v in self.__dict__.items() if k != "_weights"}

    def raw(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word; a long word's is that of its highest part."""
        if not hasattr(self, "_weights"):
            self._weights = Weights(self.codes, self.weights)
        out = np.full(len(words), -np.inf)
        pieces = [(i, p) for i, w in enumerate(words) for p in parts(w)]
        pieces.sort(key=lambda x: len(x[1]))
        for lo in range(0, len(pieces), RAW):
            some = pieces[lo:lo + RAW]
            letters = np.array([len(p) for _, p in some])
            at_row, values = [np.zeros(0, np.int64)], [np.zeros(0)]
            for off, n, code in _places([p for _, p in some]):
                at, weight = self._weights.found(code.ravel())
                r, c = np.divmod(at, code.shape[1])
                ok = c < n[r]                           # what lies behind a word's places is none
                r = r[ok]
                at_row.append(r)
                values.append(DECAY ** (off[-1] + 1 - len(off)) / _NORMS[letters[r]] * weight[ok])
            f = self.bias + np.bincount(np.concatenate(at_row), np.concatenate(values), len(some))
            np.maximum.at(out, [i for i, _ in some], f)
        return out

    def probability(self, highest: np.ndarray) -> np.ndarray:
        """highest: for each text, its TOP highest values in falling order."""
        x = np.stack([np.ones(len(highest)), highest[:, 0], highest.mean(axis=1)], axis=1)
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration, -50, 50)))


def highest(texts: list[str | None], model: Model, key: int) -> np.ndarray:
    """The TOP highest word values of each text (of distinct words), in falling order; the bias stands for missing words."""
    known = worker_cache("toxicity").setdefault(key, {})
    out, some, size = [np.zeros((0, TOP))], [], 0
    for t in texts:                                     # the words of some texts at a time: those of a batch take many times its size
        some.append(t)
        size += len(t or "")
        if size >= AT_ONCE:
            out.append(_highest(some, model, known))
            some, size = [], 0
    return np.concatenate([*out, _highest(some, model, known)])


def _highest(texts: list[str | None], model: Model, known: dict[str, float]) -> np.ndarray:
    each = [units(t) for t in texts]
    new = list(set().union(*each) - known.keys()) if each else []
    fresh = dict(zip(new, model.raw(new).tolist()))
    if len(known) < REMEMBERED:
        known.update(fresh)
        fresh_get = known.get
    else:
        def fresh_get(w):
            v = known.get(w)
            return fresh[w] if v is None else v
    floor = [min(model.bias, 0.0) - 1.0] * TOP
    return np.array([sorted([*map(fresh_get, u), *floor], reverse=True)[:TOP] for u in each]).reshape(len(texts), TOP)


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps on the points inside the margin; last weight: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-4
    for _ in range(20):
        inside = y * (x @ w) < 1
        a = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + a.T @ x[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = 0.5 * w + 0.5 * new if _ > 10 else new
    return w


def own_words(text: str | None) -> list[str]:
    return sorted(x for x in {letters(u) for u in units(text)} if 2 < len(x) <= LONGEST)


def runs(word: str) -> set[str]:
    """Runs of four to seven letters, the word's start counted as one."""
    m = f"^{word}"
    return {m[i:i + k] for k in (4, 5, 6, 7) for i in range(max(1, len(m) - k + 1))}


def _train(positive: list[str], negative: list[str], mark_pos: list[str], mark_neg: list[str]) -> tuple[np.ndarray, np.ndarray, float]:
    marks = list(dict.fromkeys([*mark_pos, *mark_neg]))
    r, code, val = subsequences(marks)
    codes, column = np.unique(code, return_inverse=True)
    phi = np.zeros((len(codes), len(marks)))
    np.add.at(phi, (column, r), val)
    root, vec = np.linalg.eigh(phi.T @ phi)
    keep = root > 1e-6
    to = vec[:, keep] / np.sqrt(root[keep])             # kernel values with the landmarks -> Nystrom features
    both = [*positive, *negative]
    k = np.zeros((len(both), len(marks)))
    for lo in range(0, len(both), 100):                 # rows of the kernel matrix, some at a time
        r, code, val = subsequences(both[lo:lo + 100])
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        hit = np.flatnonzero(codes[at] == code)
        hit = hit[np.argsort(r[hit], kind="stable")]
        if len(hit):
            rows, first = np.unique(r[hit], return_index=True)
            k[lo + rows] = np.add.reduceat(phi[at[hit]] * val[hit, None], first)
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    cost = np.concatenate([np.full(len(positive), 20.0), np.full(len(negative), min(20.0, 160.0 * max(1, len(positive)) / max(1, len(negative))))])
    w = _machine(k @ to, y, cost)
    return codes, phi @ (to @ w[:-1]), float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.clip(np.linalg.solve(h, x.T @ (y - p) - ridge @ w), -5, 5)
    return w


def sample(docs: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1) -> DataFrame:
    """(text, toxic, part): at most SAMPLE[label] distinct labelled documents of each class whose fold isn't the held-out one.
    part 0 trains the machine, part 1 calibrates."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_column(F.col("doc_id"), mod) != held)))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    some = [rows.where(F.col("toxic") == k).groupBy("doc_id").agg(F.first("toxic").alias("toxic")).orderBy(order, "doc_id").limit(SAMPLE[k]) for k in (0, 1)]
    chosen = some[0].unionByName(some[1])              # at most 4,900 rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").join(F.broadcast(chosen), "doc_id")
    return written(texts.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
                   .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
                   .withColumn("part", (F.pmod(F.xxhash64("digest"), F.lit(10)) >= 7).cast("int"))
                   .select("text", "toxic", "part"), "labelled")


def fit(labelled: DataFrame, rounds: int = 3) -> Model | None:
    """A model from sample(); None if it has no toxic or no clean document to train on."""
    spark = labelled.sparkSession

    def counted(kind):
        """Documents of each class that have a word, or a run of letters of one."""
        def frame(counts: tuple[Counter, Counter]) -> pd.DataFrame:
            w = list(counts[0].keys() | counts[1].keys())
            return pd.DataFrame({"w": pd.Series(w, dtype=object), "t": [counts[1][x] for x in w], "c": [counts[0][x] for x in w]}).astype({"t": "int64", "c": "int64"})

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts = Counter(), Counter()
            for pdf in batches:
                for t, y in zip(pdf["text"], pdf["toxic"]):
                    counts[y].update(set().union(*map(kind, own_words(t))))
                    if len(counts[0]) + len(counts[1]) >= COUNTED:
                        yield frame(counts)
                        counts = Counter(), Counter()
            yield frame(counts)
        return (trained.mapInPandas(tidy(run), "w string, t long, c long").groupBy("w")
                .agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    trained = labelled.where("part = 0")
    totals = {r["toxic"]: r["n"] for r in trained.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None

    def odds(t, c):
        return t * (np.log((t + 0.1) / (totals[1] + 0.2)) - np.log((c + 0.1) / (totals[0] + 0.2)))
    # Tables of the bounded sample.
    table = counted(lambda x: (x,)).orderBy("w").toPandas()
    w, t, c = table["w"].to_numpy(object), table["t"].to_numpy(float), table["c"].to_numpy(float)
    some = counted(runs).where(f"t > 1 and c * {totals[1]} < t * {totals[0]}").toPandas()
    tells = dict(zip(some["w"], odds(some["t"].to_numpy(float), some["c"].to_numpy(float))))
    in_clean = set(w[c > 0])
    value = {x: max(tells.get(g, -np.inf) for g in runs(x)) for x in w if x not in in_clean}
    del some, tells, in_clean
    share_value = spark.sparkContext.broadcast(value)

    def witnesses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each toxic document, the words without a place in clean ones whose letters tell most."""
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                best = sorted(((share_value.value[x], x) for x in own_words(text) if x in share_value.value), reverse=True)[:WITNESSES]
                out += [x for v, x in best if v > LEAST and v > 0.5 * best[0][0]]
            yield pd.DataFrame({"w": out}, dtype=object)
    toxic = trained.where("toxic = 1")
    positive = sorted(toxic.mapInPandas(tidy(witnesses), "w string").distinct().toPandas()["w"])
    if not positive:
        return None
    negative = np.flatnonzero(c > 0)
    rng = np.random.default_rng(3)
    common = negative[np.argsort(-c[negative], kind="stable")[:NEGATIVES // 2]]
    others = rng.permutation(np.setdiff1d(negative, common))[:NEGATIVES // 2]
    base = list(w[np.sort(np.concatenate([common, others]))])
    hard: list[str] = []
    model = None
    for step in range(rounds):
        ranked = sorted(positive, key=lambda x: (-value.get(x, -np.inf), x))
        marks = [*ranked[:LANDMARKS // 2], *rng.permutation(ranked[LANDMARKS // 2:])[:LANDMARKS // 2].tolist()]
        marks_neg = [*hard[:LANDMARKS // 2], *w[common[:LANDMARKS // 2]]]
        own = set(positive)
        codes, weights, bias = _train(positive, [x for x in dict.fromkeys([*base, *hard]) if x not in own], marks, marks_neg)
        trim()                                          # the kernel matrix goes before the next arrays come
        model = Model(codes, weights, bias, np.array([0.0, 1.0, 0.0]))
        f = model.raw(list(w))
        trim()
        hard = list(w[negative][np.argsort(-f[negative], kind="stable")[:HARD]])
        if step < rounds - 1:                           # what the machine finds in toxic documents, and no clean one has
            positive = sorted(w[(f > 0) & (c == 0) & (t > 0)]) or positive
    share_model = spark.sparkContext.broadcast(model)

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = highest(clean(pdf["text"]), share_model.value, 0)
            worker_cache("toxicity").pop(0, None)
            yield pd.DataFrame({"a": h[:, 0], "b": h.mean(axis=1), "y": pdf["toxic"].to_numpy()})
    kept = labelled.where("part = 1")
    if kept.groupBy("toxic").count().count() < 2:
        kept = labelled
    cal = kept.mapInPandas(tops, "a double, b double, y int").orderBy("a", "b", "y").toPandas()
    x = np.stack([np.ones(len(cal)), cal["a"], cal["b"]], axis=1)
    model.calibration = _logistic(x, cal["y"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """docs with the probability that label 1 is right, by the whole of column text. Null and empty texts
    are scored as texts without words. Without a model (nothing to learn from) the score is 0. Rows stay as they are,
    repeated ones too."""
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    prepare(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(model)
    key = abs(hash((model.bias, len(model.codes), float(model.weights.sum())))) + 1

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trim()                                          # what fits and other stages left in the worker
        for texts in batches:
            yield pd.Series(share.value.probability(highest(clean(texts), share.value, key)))
    return docs.withColumn(column, run(F.col("text").cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs; see fit() and score(). Labels of null ids or other
    values than 0 and 1 are not used; a document labelled twice counts once."""
    prepare(docs.sparkSession)
    model = fit(sample(docs, labels, mod, held))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(rows, model).select(
        "doc_id", (fold_column(F.col("doc_id"), mod) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold."""
    prepare(docs.sparkSession)
    scored = score(docs, fit(sample(docs, labels)), "__toxicity")
    return scored.where(F.col("__toxicity") < threshold).drop("__toxicity")
