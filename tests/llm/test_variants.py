"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from saleslens.llm import variants

RNG = random.Random(12)
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    base = ["".join(RNG.choices("abcé", k=RNG.randint(6, 11))) for _ in range(60)]
    long = "".join(RNG.choices("abc", k=3000))
    out = [(None, "abcabcabc"), (1, None), (2, ""), (3, "ABCABCABC abcabcabc"), (3, "ABCABCABC abcabcabc"),
           (4, "ÀÉÎabcd àéîabcd ÀÉÎabcd"), (5, f"{long} {long} {long[:-1]} {long[:-1]} {long[:700]}x{long[701:]}"),
           (6, f"{long[:700]}x{long[701:]} Ωmegabcd漢abcabcabc ½ßtrasse÷strasse")]
    for i in range(10, 160):
        ws = RNG.choices(base, weights=[1000 // (j + 1) for j in range(len(base))], k=60)
        for j in range(0, len(ws), 7):
            w, k = ws[j], RNG.randrange(len(ws[j]))
            ws[j] = RNG.choice([w[:k] + w[k + 1:], w[:k] + "a" + w[k:], w[:k] + "b" + w[k + 1:]])
        out.append((i, " ".join(ws) + "."))
    return out


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(table, every, min_count, ratio):
    counts = Counter()
    for d, t in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


@pytest.mark.parametrize("every,min_count,ratio", [(31, 2, 10), (3, 1, 2)])
@pytest.mark.parametrize("block", [4096, 20])
def test_variants(spark, monkeypatch, every, min_count, ratio, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    table = rows()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("word", "n", "m", "side", "piece")])
    got = [tuple(r) for r in variants.spelling_variants(df, 7, every, min_count, ratio).collect()]
    want = brute(table, every, min_count, ratio)
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 5 and any(r[1] and r[1] != r[2] for r in want) == (ratio == 2)


@pytest.mark.parametrize("block,small,tile", [(4096, 48, 512), (20, 1, 7), (40, 5, 16)])
def test_every_pair_is_found_once(spark, monkeypatch, block, small, tile):
    for name, value in (("BLOCK", block), ("SMALL", small), ("TILE", tile)):
        monkeypatch.setattr(variants, name, value)
    words = sorted({"".join(RNG.choices("ab", k=RNG.randint(7, 9))) for _ in range(1500)})
    dealt = variants._groups(spark.createDataFrame([(w, 2) for w in words], "word string, n long"))
    pdf = dealt.toPandas().sort_values(["m", "side", "piece", "p", "q"], ignore_index=True)
    assert (pdf["q"].max() > 0) == (block < 4096)
    _, x, y = variants._pairs(pdf)
    word = pdf["word"].to_numpy()
    got = Counter(tuple(sorted(pair)) for pair in zip(word[x], word[y]))
    assert got == Counter(p for p in itertools.combinations(words, 2) if one_edit(*p))


def test_empty_table(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (2, "short words")], "doc_id long, text string")).count() == 0
