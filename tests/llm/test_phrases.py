"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslens.llm import phrases

RNG = random.Random(13)
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    out = [(1, None, "en"), (2, "", "en"), (3, "Été\xa0x a b", None), (4, "a.b a b,a b", "und"), (5, " . ,;", "de"), (6, "A B\tC\x0bA b\x1fc", "en")]
    words = [f"w{i}" for i in range(12)] + ["Über", "New", "york"]
    for i in range(10, 120):
        body = []
        for _ in range(RNG.randint(1, 60)):
            body += RNG.choice([[RNG.choice(words)], ["New", "York", "City"], ["w1", "w2", "w3", "w4", "w5", "w6"], ["of", "of", "of"]])
            if RNG.random() < .1:
                body[-1] += RNG.choice([".", ",", "!\n", ";", "\r"])
        out.append((i, " ".join(body), RNG.choice(["en", "de", None])))
    return out + out[20:25]


def brute(table, longest, least, top, within):
    f, n = Counter(), Counter()
    for _, text, lang in table:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UP)):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if 2 <= len(p[1]) and a >= least}
    found = []
    for (lang, p), a in cand.items():
        def contains(q):
            return any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and contains(q) and 100 * b >= within * a for (x, q), b in cand.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        found.append((lang, -score, -a, " ".join(p).encode(), left, right))
    out, rank = set(), Counter()
    for lang, s, a, p, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.add((lang, rank[lang], p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("shard", [1 << 18, 40])
@pytest.mark.parametrize("longest,least,top,within", [(5, 10, 2000, 100), (4, 3, 25, 60), (2, 5, 2000, 100)])
def test_collocations(spark, monkeypatch, shard, longest, least, top, within):
    monkeypatch.setattr(phrases, "SHARD", shard)
    table = rows()
    df = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("word", "words", "f", "h", "ids")])
    got = [tuple(r) for r in phrases.collocations(df, longest, least, top, within).collect()]
    want = brute(table, longest, least, top, within)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 15


def test_empty_tables(spark):
    for table in ([], [(1, None, None), (2, "one two", "en")]):
        assert phrases.collocations(spark.createDataFrame(table, "doc_id long, text string, lang string")).count() == 0


def test_trie_counts_all_positions():
    rng = np.random.default_rng(3)
    words = rng.integers(-2**62, 2**62, 300)
    x = np.where(rng.random(20_000) < .1, 0, words[rng.integers(0, 300, 20_000) % rng.integers(1, 300, 20_000)])
    grams = Counter()
    for k in range(2, 6):
        for i in range(len(x) - k + 1):
            if (x[i:i + k] != 0).all():
                grams[tuple(x[i:i + k].tolist())] += 1
    chosen = RNG.sample(sorted(grams), 3000) + [tuple(words[:5].tolist()) + ()]
    chosen = list(dict.fromkeys(chosen))
    paths = np.zeros((len(chosen), 5), np.int64)
    for i, g in enumerate(chosen):
        paths[i, :len(g)] = g
    trie = phrases.Trie(paths)
    total = np.zeros(len(chosen) + 1, np.int64)
    for part in np.array_split(np.append(x, 0), [0]):
        trie.count(part, total)
    assert total[1:].tolist() == [grams[g] for g in chosen]


def test_few_positions_are_worked_on_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 1 << 40, 1000) for _ in range(900)]
    full = np.full((1 << phrases.BITS) // 8, 255, np.uint8)

    class Known:
        value = full

    class Texts:
        def mapInPandas(self, fn, schema):
            return fn
    sizes, starts = [], phrases._starts
    monkeypatch.setattr(phrases, "_starts", lambda x, *a: (sizes.append(len(x)), starts(x, *a))[1])
    batches = [phrases.pd.DataFrame({"ids": [t.tobytes() for t in texts[lo:lo + 100]]}) for lo in range(0, 900, 100)]
    frames = list(phrases.possible(Texts(), [Known, Known], 2, 3)(iter(batches)))
    assert max(sizes) < 300_000 and max(map(len, frames)) <= 1 << 17
    got = phrases.pd.concat(frames)
    assert got["c"].sum() == 900 * 998                                  # runs of three words
    pairs = got.loc[got["h"].notna()]
    want = np.concatenate([phrases.mix(t[:-1], t[1:]) for t in texts])
    assert sorted(pairs["h"].astype("int64")) == sorted(set(want.tolist()))
