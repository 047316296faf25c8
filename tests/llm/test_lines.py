"""Line dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from saleslens.llm import lines

RNG = random.Random(11)
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    common = [f"Common line {i}" for i in range(5)]
    out = [(1, None), (2, ""), (3, "\n\n"), (None, "Common line 0\nown"), (None, "Common line 0\nother"),
           (4, "  COMMON LINE 0\t\nkept"), (4, "  COMMON LINE 0\t\nkept"), (4, "same id, other text\n\x0bcommon line 0"),
           (5, "\xa0Common line 0\nÄpfel"), (6, "äpfel")]
    for i in range(10, 45):
        own = [f"line {RNG.randrange(10**6)}" for _ in range(RNG.randint(0, 6))] + RNG.sample(common, RNG.randint(0, 3)) + [" "]
        RNG.shuffle(own)
        out.append((i, "\n".join(own)))
    out.append((99, "\n".join(x for i in range(400) for x in ("common line 1", f"l{i}"))))        # many words of a bitmap
    out.append((98, "only here\n" * 500))                                                         # one document's own repeats
    out.append((97, "\n".join(["x"] * 130 + ["Common line 2"])))
    return out


def brute(table, min_docs, min_chars):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UP)
    seen = defaultdict(set)
    for d, t in table:
        for line in (t or "").split("\n"):
            seen[key(line)].add((d, t or ""))
    gone = {k for k, v in seen.items() if len(v) >= min_docs and len(k) >= min_chars}
    for d, t in table:
        ls = (t or "").split("\n")
        kept = "\n".join(x for x in ls if key(x) not in gone)
        n = sum(key(x) in gone for x in ls)
        yield d, t, len(ls), n, kept


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 2), (1, 1)])
def test_lines(spark, min_docs, min_chars):
    table = rows()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    want = list(brute(table, min_docs, min_chars))
    got = lines.line_digests(df, min_docs, min_chars).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        str((d, n, g, hashlib.sha256(k.encode()).hexdigest())) for d, _, n, g, k in want)
    assert any(g for _, _, _, g, _ in want)
    out = lines.dedup_lines(df, min_docs, min_chars).collect()
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(str((d, t if g == 0 else k)) for d, t, _, g, k in want)


def test_clashing_columns_stay(spark):
    names = ["d", "t", "pos", "h1", "n_dropped", "dense", "_dense", "text_hash", "keep", "word", "bits"]
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    df = df.select("*", *[F.lit(n).alias(n) for n in names])
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    assert out.select(*names).distinct().collect() == [tuple(names)]
    assert out.count() == df.count()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.line_digests(empty).count() == 0 and lines.dedup_lines(empty).count() == 0


def test_hot_key_is_spread_and_rows_stream_once(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same\n").alias("text"))
    shared = lines.shared_lines(lines.line_hashes(df), 10)
    assert [(r.n_rows, r.n_docs) for r in shared.collect()] == [(4000, 4000)]
    plan = shared._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Pandas" not in plan
