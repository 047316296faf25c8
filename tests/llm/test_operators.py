"""The dealt operators against brute force on small tables with nulls, ties, repeated rows and clashing columns."""

import gc
import hashlib
import io
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslens.llm import decontaminate, embeddings, hmm, html_extract, packing, simhash, substrings, tokenfile, tokens, toxicity, warc

RNG = random.Random(4)
VOCAB = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(RNG.choices(VOCAB, k=60))


def texts():
    out = [(None, "x y z", 1), (1, None, 1), (2, "", 1), (3, "one two", 1), (3, "one two", 2)]
    for i in range(10, 60):
        body = " ".join(RNG.choices(VOCAB, k=RNG.randint(5, 200)))
        if i % 4 == 0:
            body = f"{body} {PASSAGE} {' '.join(RNG.choices(VOCAB, k=20))}"
        out.append((i, body, i))
    out += [(100, out[10][1], 0), (101, out[10][1], 0), (102, "Ab c\n d\x0be " + out[12][1], 0), (103, " ".join(RNG.choices(VOCAB, k=9000)), 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = texts()
    return rows, spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("k1", F.lit("clash")).repartition(3)


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)


def test_simhash_components(spark, docs):
    rows, df = docs
    got = simhash.simhash_dedup(df, 4, 4).collect()
    assert len(got) == len(rows)
    fp = [(d, simhash.fingerprint(t, 4)) for d, t, _ in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(d), f"{f:016x}") for d, f in fp)
    up = {f: f for _, f in fp}

    def root(x):
        return x if up[x] == x else root(up[x])
    for a, b in itertools.combinations(list(up), 2):
        if (a ^ b).bit_count() <= 4:
            up[root(a)] = root(b)
    least = {}
    for d, f in fp:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    assert {(r.doc_id, r.component_id) for r in got} == {(d, least.get(root(f))) for d, f in fp}
    assert simhash.simhash_dedup(empty(spark)).count() == 0
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()).most_common(1)[0][1] == 1


def test_covering_masks_meet_every_pair():
    family = simhash.masks(4)
    assert len(family) == 31
    for _ in range(3000):
        d = sum(1 << b for b in RNG.sample(range(64), 4))
        assert any(m & d == 0 for m in family)


def removed(rows, window=35):
    split = [(t or "").encode().split() for _, t, _ in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    for (d, _, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        yield d, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()


def test_substring_dedup(spark, docs):
    rows, df = docs
    want = list(removed(rows))
    got = substrings.word_digests(df).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(x[:4]) for x in want)
    out = substrings.substring_dedup(df)
    assert out.columns == df.columns
    expected = sorted(str((d, t if n == 0 else kept)) for (d, t, _), (_, _, n, _, kept) in zip(rows, want))
    assert sorted(str((r.doc_id, r.text)) for r in out.select("doc_id", "text").collect()) == expected
    assert substrings.word_digests(empty(spark)).count() == 0


def test_packing_and_token_files(spark, docs):
    rows, df = docs
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    want = Counter((d, np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, t, _ in rows)
    placed, cut = packing.pack(df, path, 1, 2048)
    r = placed.toPandas().sort_values(["sequence_id", "offset"])
    end = r.groupby("sequence_id")["length"].cumsum()
    assert (r["offset"] == end - r["length"]).all() and end.max() <= 2048
    by_doc: dict = {}
    for x in sorted(cut.collect(), key=lambda x: x.row_id):
        by_doc.setdefault((x.row_id - x.start // 2048, x.doc_id), []).append(bytes(x.ids))
    assert Counter((k[1], b"".join(v)) for k, v in by_doc.items()) == want
    ids = {x.sequence_id: bytes(x.ids) for x in packing.sequences(placed, cut).collect()}
    assert all((n := len(v) // 4) & (n - 1) == 0 for v in ids.values())
    manifest = tokenfile.write_tokens(df, path, 1)
    back = tokenfile.read_tokens(manifest).orderBy("start").collect()
    assert Counter((x.doc_id, bytes(x.ids)) for x in back) == want
    assert [x.start for x in back] == list(itertools.accumulate([0] + [x.n_tokens for x in back]))[:-1]
    assert [x.doc_id or -1 for x in back] == sorted(x.doc_id or -1 for x in back)
    assert packing.pack(empty(spark), path)[0].count() == 0
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty(spark), path)).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", "\n\nx", "a \n b", "Hello, wörld!!", "it's  1234 ok.", "a b c d", "<|endoftext|> x", "é́ x", "x" * 3000])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_by_word_ids_are_the_librarys(text, name):
    path = tokens.tokenizer_path(name)
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    for t in (text, f"word {text}", f"{text} word, again {text}."):
        want = np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert tokens.encoder(path).encode([t, None]) == [want, b""]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_random_texts_are_the_librarys(name):
    path = tokens.tokenizer_path(name)
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    rng = random.Random(5)
    bits = ["İ", "İ", "i̇", "é", "e\u0301", "ß", "ſ", "Ω", "K", "a", "B", "the", "Word", "don't", "'s", "'ll", ".", ",", "!?", "*", "~", "|", "<|", "|>", "#",
            "1", "23", "ª", "ⅷ", "中文", "한글", "\u200d", "\u0300", "👍🏽", "\u00a0", "\t", "\x1c", "\x85", "\r", "<|endoftext|>", "<|startoftext|>"]
    texts = []
    for _ in range(20_000):
        words = ["".join(rng.choices(bits, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 9))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "\n", "  "] if rng.random() < .9 else ["\n\n", " \n", ""]) for w in words).strip(" \n") or "x")
    want = [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch_fast(texts, add_special_tokens=False)]
    got = tokens.Encoder(path).encode(texts)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_packing_patterns_place_everything():
    counts = {n: RNG.randint(1, 50) for n in RNG.sample(range(1, 2049), 300)}
    patterns = packing.shortest_pack_first(counts, 2048)
    back = Counter()
    for p, n in patterns:
        assert sum(p) <= 2048
        for size in p:
            back[size] += n
    assert back == counts


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    v = np.where(rng.random(128 * 50) < 0.05, rng.integers(0, 2 ** 32, 128 * 50), rng.integers(0, 900, 128 * 50)).astype(np.uint32)
    raw, sizes = tokenfile.encode_blocks(v)
    assert (tokenfile.decode_blocks(raw, np.cumsum(sizes) - sizes) == v).all()


def test_warc_salvage():
    recs = [warc.record(i, f"http://h/{i}", bytes([65 + i]) * 50, None) for i in range(5)]
    members = []
    for r in recs:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        members.append(z.compress(r) + z.flush())
    bad = bytearray(members[2])
    bad[len(bad) // 2] ^= 255
    data = members[0] + members[1] + bytes(bad) + members[3] + b"junk" + members[4][:-9]
    got = list(warc.read_warc(io.BytesIO(data)))
    assert [x.head["x-page-id"] for x in got if isinstance(x, warc.Record)] == ["0", "1", "3"]
    at = len(members[0]) + len(members[1])
    assert [(g.at, g.to) for g in got if isinstance(g, warc.Gap)] == [(at, at + len(bad)), (at + len(bad) + len(members[3]), len(data))]
    plain = recs[0] + recs[1][:60] + recs[3] + recs[4]
    got = list(warc.read_warc(io.BytesIO(plain)))
    assert [x.head["x-page-id"] for x in got if isinstance(x, warc.Record)] == ["0", "3", "4"]
    assert list(warc.read_warc(io.BytesIO(b""))) == []


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (3, None, "x"), (4, "u", "x"), (5, "u", None), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    got = warc.read_archives(warc.write_archives(df)).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in got) == sorted(map(str, [
        (1, 1200, "revisit", 2), (2, 1200, "response", None), (2, 1200, "response", None), (3, 1, "response", None),
        (4, 1, "response", None), (5, 0, "response", None), (None, 1200, "response", None)]))
    assert {r.payload_digest for r in got if r.page_id == 1} == {hashlib.sha1(big.encode()).hexdigest()}
    assert warc.read_archives(warc.write_archives(empty(spark, "page_id long, url string, html string"))).count() == 0


def test_warc_salvage_in_members():
    rng = random.Random(5)
    recs = [warc.record(i, f"http://h/{i}", rng.randbytes(40_000), None) for i in range(6)]
    small = [warc.record(i, f"http://h/{i}", bytes([65 + i]) * 50, None) for i in range(6)]

    def member(data):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()

    def read(data):
        got = list(warc.read_warc(io.BytesIO(data)))
        return [int(x.head["x-page-id"]) for x in got if isinstance(x, warc.Record)], [(g.at, g.to) for g in got if isinstance(g, warc.Gap)]
    for r in (recs, small):
        hurt = bytearray(r[1])
        hurt[-8] ^= 1
        one = member(r[0] + bytes(hurt) + r[2])
        assert read(one) == ([0, 2], [(0, len(one))])
        assert read(b"junk" + one + member(r[3])) == ([0, 2, 3], [(0, 4), (4, 4 + len(one))])
        whole = bytearray(member(b"".join(r[:3])))
        whole[-6] ^= 1                                     # the member's checksum
        ids, gaps = read(bytes(whole) + member(r[3]))
        assert ids == [0, 1, 2, 3] and len(gaps) == 1 and gaps[0][1] == len(whole)
    broken = member(b"".join(recs))
    cut = len(broken) * 7 // 12                            # in the fourth record
    ids, gaps = read(broken[:cut] + member(recs[5]))
    assert ids == [0, 1, 2, 5] and len(gaps) == 1 and gaps[0][1] == cut


def test_warc_long_headers(spark):
    url = "http://h/" + " \n" * 50_000
    recs = [warc.record(1, url, b"a" * 50, None), warc.record(2, "http://h/2", b"b" * 50, None)]
    got = list(warc.read_warc(io.BytesIO(b"".join(recs))))
    assert [x.head["x-page-id"] for x in got] == ["1", "2"] and len(got[0].head["warc-target-uri"]) == 9 + 300_000
    manifest = warc.write_archives(spark.createDataFrame([(1, url, "x"), (2, "u", "y")], "page_id long, url string, html string"))
    assert sorted((r.kind, r.page_id) for r in warc.read_archives(manifest, whole=True).collect()) == [("record", 1), ("record", 2)]
    with pytest.raises(Exception, match="records read"):
        warc.read_archives(manifest.withColumn("n", F.col("n") + 1), whole=True).collect()


def test_toxicity_words_are_scored_by_small_tables_as_by_the_plain_sum():
    words = sorted({"".join(RNG.choices("abcdeé", k=RNG.randint(0, 30))) for _ in range(600)} | {"x" * 100, "", "a"})
    r, code, _ = toxicity.subsequences(words[:200])
    codes = np.unique(code)
    model = toxicity.Model(codes, np.linspace(-1, 1, len(codes)), -0.5, np.zeros(3))
    weight = dict(zip(codes.tolist(), model.weights.tolist()))
    want = []
    for w in words:
        plain = []
        for p in toxicity.parts(w):
            _, c, v = toxicity.subsequences([p])
            plain.append(-0.5 + sum(weight.get(x, 0.0) * y for x, y in zip(c.tolist(), v.tolist())))
        want.append(max(plain))
    assert np.allclose(model.raw(words), want, rtol=0, atol=1e-9)
    # A worker's tables are in proportion to the weights.
    assert sum(x.nbytes for t in model._weights.tables for x in t if isinstance(x, np.ndarray) and x.ndim) <= 1024 * len(codes)


def test_encoding_does_not_search_for_cycles():
    encoder = tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    runs = []
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        encoder.encode([" ".join(f"{w}{i}," for w in VOCAB) for i in range(60)])
    finally:
        gc.callbacks.pop()
    assert not runs and gc.isenabled()


def test_html_structure():
    page = ("<html><head><title>t</title></head><body><nav><a>Menu</a></nav><div class='cookie-notice'>Accept</div><article><h1>A &amp; B</h1>"
            "<p>One<br>two  <b>three</p><script>var a='</p>'</script><aside>side</aside><div class=\"share-buttons\">Share</div>"
            "<ul><li>x<li>y</ul><section id=comments><p>nice!</p></section></article><footer>&copy;</footer></body>")
    assert html_extract.read_page(page)[0] == ["A & B", "One two three", "x", "y"]
    assert html_extract.read_page(None) == ([], [], []) and html_extract.read_page("")[0] == []
    assert html_extract.read_page("<article><p>cut off he")[0] == ["cut off he"]


def test_html_repeated_runs(spark):
    boiler = "subscribe to our weekly letter and never miss a single story again"
    own = ["alpha beta gamma delta", "a second page of other words"]
    rows = [(i, f"http://h.example/{i}", f"<div><p>{boiler}</p><p>{t}</p></div>") for i, t in enumerate(own)]
    rows += [(7, "http://other.example/", f"<p>{boiler}</p>"), (8, None, None), (9, "x", "")]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: own[0], 1: own[1], 7: boiler, 8: "", 9: ""}
    assert html_extract.extract(empty(spark, "page_id long, url string, html string")).count() == 0


def test_html_copies_and_quotes_keep_their_text(spark):
    boiler = "subscribe to our weekly letter and never miss a single story again"
    own = ["one page that stands under several urls of its host and is no boilerplate", *(f"{w} has text" for w in ("alpha", "beta", "gamma"))]
    quote = "a paragraph of more than eight words that a second page quotes whole"
    rows = [(i, f"http://copies.example/{i}", f"<p>{own[0]}</p>") for i in range(4)]
    rows += [(10 + i, f"http://h.example/{i}", f"<div><p>{boiler}</p><p>{t}</p></div>") for i, t in enumerate(own)]
    rows += [(20 + i, f"http://h.example/q{i}", f"<p>{quote}</p><p>{i}</p>") for i in range(2)]
    rows += [(30, "http://h.example/again", rows[4][2])]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: own[0] for i in range(4)} | {10 + i: t for i, t in enumerate(own)} | {20: f"{quote}\n0", 21: f"{quote}\n1", 30: own[0]}
    assert got == want


def test_html_repeated_runs_of_articles(spark):
    boiler = "subscribe to our weekly letter and never miss a single story again"
    quote = "a sentence of more than eight words that only some articles of a host share"
    body = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(6)]
    near = [" ".join(f"n{k}" if k != 30 * i else f"changed{i}" for k in range(200)) for i in range(4)]
    rows = [(i, f"http://h.example/{i}", f"<nav>menu</nav><article><p>{t}</p><p>{boiler}</p>{f'<p>{quote}</p>' if i < 3 else ''}</article>") for i, t in enumerate(body)]
    rows += [(10 + i, f"http://h.example/copy{i}", rows[0][2]) for i in range(9)]             # copies are no articles of their own
    rows += [(20 + i, f"http://two.example/{i}", f"<main><p>{body[i]}</p><p>{boiler}</p></main>") for i in range(2)]
    rows += [(30 + i, f"http://near.example/{i}", f"<article><p>{t}</p></article>") for i, t in enumerate(near)]
    rows += [(40 + i, "http://within.example/", f"<article><p>{boiler} {t} {boiler}</p></article>") for i, t in enumerate(body[:3])]
    rows += [(50, "http://empty.example/", "<article></article>"), (51, None, f"<article>{boiler}</article>")]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    want = {i: f"{t}\n{quote}" if i < 3 else t for i, t in enumerate(body)} | {10 + i: f"{body[0]}\n{quote}" for i in range(9)}
    want |= {20 + i: f"{body[i]}\n{boiler}" for i in range(2)} | {30 + i: t for i, t in enumerate(near)}
    want |= {40 + i: body[i] for i in range(3)} | {50: "", 51: boiler}
    assert got == want


def test_html_article_runs_are_those_of_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    pages = [(h, " ".join(rng.choices("abc", k=rng.randint(0, 60))) + "\n" + " ".join(rng.choices("ab", (9, 1), k=rng.randint(1, 60)))) for h in "xyz" for _ in range(rng.randint(3, 12))]
    pages += pages[:4]
    want = {}
    for h in "xyz":
        own = {m for x, m in pages if x == h}
        count = Counter(r for m in own for t in [html_extract.stream_of(m.split("\n"))]
                        for r in {" ".join(t[i:i + html_extract.RUN]) for i in range(len(t) - html_extract.RUN + 1)})
        want[h] = {r for r, n in count.items() if n >= 3 and 2 * n > len(own)}
    df = spark.createDataFrame(pages, "host string, main string").repartition(4)
    for small in (html_extract.SMALL, 0):
        monkeypatch.setattr(html_extract, "SMALL", small)
        assert {r.host: set(r.runs) for r in html_extract.article_runs(df).collect()} == {h: r for h, r in want.items() if r}
    assert any(want.values())


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, (base[i] + rng.standard_normal(16) * 0.3).tolist()) for i in range(100)]
    rows += [(400, base[0].tolist()), (401, (base[0] * 2).tolist()), (500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, []), (504, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit(1))
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    ok = [(i, np.array(v)) for i, v in rows if v and len(v) == 16 and np.isfinite(v).all() and any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in ok])
    near = x @ x.T >= 0.9
    total = int(near.sum() - len(x))
    found = sum(r.n_links for r in got.values())
    assert 0.97 * total <= found <= total and got[401].component_id == 0 and not got[401].kept
    assert all(got[i].n_links == 0 and got[i].kept for i in range(500, 505))
    assert embeddings.near_duplicates(empty(spark, "vec_id long, embedding array<float>")).count() == 0


def test_embeddings_of_rows_that_share_an_id(spark):
    e1, e2 = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, e1), (1, e2), (2, [0.0, 1.0, 0.1, 0.0]), (None, e1), (3, [0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit("x")).withColumn("side", F.lit(1))
    got = sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in embeddings.near_duplicates(df).collect())
    assert got == sorted(map(str, [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 1, None, False), (3, 0, 3, True)]))
    rows = [(1, e1), (1, e2), (2, [0.0, 1.0, 0.1, 0.0])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links) for r in got) == [(1, 0), (1, 1), (2, 1)]


def test_embedding_recall_with_cuts(spark):
    """Planted pairs between 0.9 and 0.93 among more vectors than one cell holds, against all cosines."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((8_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.standard_normal((2_000, 32))
    other -= (other * x[:2_000]).sum(axis=1)[:, None] * x[:2_000]
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = rng.uniform(0.9001, 0.93, 2_000)[:, None]
    x = np.vstack([x, c * x[:2_000] + np.sqrt(1 - c * c) * other])
    assert embeddings.cut_count(len(x)) > 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = np.zeros(len(x), np.int64)
    for r in embeddings.near_duplicates(df).collect():
        got[r.vec_id] = r.n_links
    assert want.sum() >= 4_000 and (got <= want).all() and got.sum() >= 0.99 * want.sum()


@pytest.mark.parametrize("n", [100, 8_192, 1 << 20, 4 << 20, 64 << 20, 1 << 40])
def test_embedding_recall_at_every_size(n):
    cuts = embeddings.cut_count(n)
    parted = cuts * math.erfc(embeddings.reach_of(cuts) / math.sqrt(2))
    assert parted + 1 - embeddings.reached(1.0, embeddings.least_count(1.0)) <= 1 - embeddings.RECALL + 1e-12


def test_decontamination(spark):
    words = [f"b{i}" for i in range(30)]
    item = " ".join(words)
    near = " ".join([*words[:29], "other"])
    far = " ".join(words[:15])
    rows = [(1, f"x y {item.upper()} z"), (2, f"{near}"), (3, far), (4, None), (5, ""), (6, "quite other words here and there"), (7, item), (7, item), (8, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("w", F.lit(1))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "a b")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.similarity, 3)) for r in decontaminate.contaminated(df, bench).collect())
    assert got == [(1, 1, 1.0), (2, 1, round(25 / 27, 3)), (7, 1, 1.0), (7, 1, 1.0), (8, 4, 1.0)]
    kept = decontaminate.keep_uncontaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(df, empty(spark, "item_id long, text string")).count() == 0


def test_decontamination_lays_every_window(spark):
    """Passages whose parts stand in another order, against a comparison of all windows."""
    item = [f"b{i}" for i in range(55)]
    rows = [(k, [f"d{k}x{i}" for i in range(before)] + item[moved:] + item[:moved] + [f"e{k}x{i}" for i in range(after)])
            for k, (moved, before, after) in enumerate([(20, 100, 100), (27, 100, 100), (27, 0, 60), (20, 60, 0), (20, 0, 0)])]
    # Half of the item only, and a document shorter than it.
    rows += [(8, [*item[:30], *(f"z{i}" for i in range(100))]), (9, item[2:])]

    def shingles(w):
        return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1)))

    def similarity(a, b):
        common = sum((a & b).values())
        return common / (a.total() + b.total() - common)
    best = {k: max(similarity(shingles(w[s:s + 55]), shingles(item)) for s in range(max(len(w) - 54, 1))) for k, w in rows}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: round(r.similarity, 6) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {k: round(v, 6) for k, v in best.items() if v >= 0.8} and {0, 1, 2, 3, 4, 9} == set(got)


def test_forward_is_exact_and_counts_sum():
    k, s = 3, hmm.SYMBOLS
    rng = np.random.default_rng(0)
    emit = np.zeros((s, k))
    emit[[0, 1, s - 1]] = rng.dirichlet(np.ones(3), k).T
    m = hmm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), emit)
    seqs = [np.array(x) for x in ([0, 1, s - 1], [s - 1], [1, 1, 0, 0, s - 1])]
    order, flat, at, alive = hmm._time_major(seqs)
    like = np.empty(3)
    like[order] = hmm.forward(m, flat, at, alive, False)[0]
    for q, got in zip(seqs, like):
        total = sum(np.prod([m.start[p[0]]] + [m.move[a, b] for a, b in zip(p, p[1:])]) * np.prod([emit[x, z] for x, z in zip(q, p)])
                    for p in itertools.product(range(k), repeat=len(q)))
        assert np.isclose(got, np.log(total))
    start, moves, emits = hmm.expected(m, seqs)
    assert np.isclose(start.sum(), 3) and np.isclose(moves.sum(), 6) and np.isclose(emits.sum(), 9)


def test_hmm_scores(spark, docs):
    rows, df = docs
    got = hmm.score_texts(df, states=2, passes=1).collect()
    split = [(d, (t or "").encode().lower().split() + [b""]) for d, t, _ in rows]
    count = Counter()
    for d, w in split:
        if zlib.crc32(b"" if d is None else str(d).encode()) % 5 != 1:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = sorted(str((d, len(w), sum(x in count for x in w), n, round(float(sum(np.log10(count[x] + 0.5) - np.log10(n + 0.5 * (v + 1)) for x in w)), 4))) for d, w in split)
    assert sorted(str((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.score_texts(empty(spark)).count() == 0


def test_toxicity(spark):
    insults = ["blorgface", "zunkwit", "grimpnose", "snarfbag"]
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(300):
        w = rng.choices([f"{a}{b}" for a in ("ti", "on", "er", "the", "an") for b in ("ng", "re", "st", "ou", "le", "sha")], k=40)
        toxic = i % 4 == 0
        if toxic:
            for x in rng.sample(insults, 2):
                w.insert(rng.randrange(40), x)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(900, "the b.l.o.r.g.f.a.c.e and z u n k w i t here"), (901, None), (902, ""), (903, "tire onst " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(df, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")).collect()}
    assert len(got) == 304 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i in range(300) if got[i].held_out]
    assert held and sum(got[i].predicted == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[900].predicted == 1 and got[901].predicted == got[902].predicted == got[903].predicted == 0
    none = toxicity.toxicity(df, empty(spark, "doc_id long, toxic int"))
    assert {r.predicted for r in none.collect()} == {0}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_are_cut_by_slices_and_memory_of_parts_is_bounded(monkeypatch, name):
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    monkeypatch.setattr(tokens, "AT_ONCE", 300)
    texts = [" ".join(f"{a}{i}{b}" for i in range(j, j + 12)) + "\nnext line" for j in range(40) for a, b in (("Wort", "!!"), ("é", ""), ("x", "\nY,"))]
    texts += [None, "", " ", "a", "a  b", "a <|endoftext|> b", "word!!! Word", "x" * 900 + " y."]
    e = tokens.Encoder(tokens.tokenizer_path(name))
    sizes, slices, cut = [], [], e._some

    def watched(some):
        slices.append(len(some))
        out = cut(some)
        sizes.append(len(e.after_space))
        return out
    monkeypatch.setattr(e, "_some", watched)
    want = [np.array(e.library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want and e.encode(texts) == want
    assert max(slices) < len(texts) / 4                                # few texts are in parts at a time
    full = next(n for n in sizes if n >= 60)
    assert set(sizes[sizes.index(full):]) == {full}                    # full: later parts are let go


def test_forward_is_the_plain_recursion():
    rng = np.random.default_rng(7)
    m = hmm.Hmm(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(hmm.SYMBOLS), 3).T.copy())
    seqs = [rng.integers(0, hmm.SYMBOLS, n).astype("<u2") for n in (5, 1, 9, 5)]
    order, flat, at, alive = hmm._time_major(seqs)
    like, alphas, scales = hmm.forward(m, flat, at, alive, True)
    assert np.array_equal(like, hmm.forward(m, flat, at, alive, False)[0]) and len(alphas) == len(scales) == 20
    for row, i in enumerate(order):
        a = m.start * m.emit[seqs[i][0]]
        for x in seqs[i][1:]:
            a = (a @ m.move) * m.emit[x]
        assert like[row] == pytest.approx(np.log(a.sum()), rel=1e-12)
    _, moves, emits = hmm.expected(m, seqs)
    assert moves.sum() == pytest.approx(16) and emits.sum() == pytest.approx(20)


def test_shingles_as_columns_are_those_of_the_array(spark):
    """Places and hashes without a function called for each word, also of texts shorter than a shingle."""
    texts = ["", " ", "a", "A b", "a b c d", "a b c d E", "a\tb\x0bc\x0cd\r\ne f  g ", "\u0130 \u00c4b \u00e4 x\u00a0y z w q", None, " ".join("ab" * 40)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    split = F.filter(F.split(F.translate("text", decontaminate.UPPER, decontaminate.LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    assert df.where(~split.eqNullSafe(decontaminate.word_array(F.col("text")))).count() == 0
    rows = df.select("k", decontaminate.word_array(F.col("text")).alias("w"))
    got = decontaminate.placed_shingles(rows, "k")
    want = rows.select("k", F.size("w").alias("n"), F.posexplode(decontaminate.shingle_hashes("w")).alias("p", "h"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 20
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString().lower()


def test_toxicity_counts_are_handed_on_in_parts(spark, monkeypatch):
    """The fit counts words and runs in the tasks, a bounded number at a time, with the same model."""
    rng = random.Random(9)
    common = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    rows = [(" ".join(rng.choices(common, k=30) + ["grottig" + rng.choice("erns")] * (i % 2)), i % 2, int(i % 10 > 7)) for i in range(120)]
    labelled = spark.createDataFrame(rows, "text string, toxic int, part int").cache()
    models = []
    for most in (toxicity.COUNTED, 40):
        monkeypatch.setattr(toxicity, "COUNTED", most)
        models.append(toxicity.fit(labelled))
    assert np.array_equal(models[0].codes, models[1].codes) and np.array_equal(models[0].weights, models[1].weights)
    assert models[0].raw(["grottiger"])[0] > 0 > models[0].raw(common[:5]).max()


def test_words_need_no_mark_between_them():
    """Where the vocabulary marks the ends of words, parts of one word are told apart by these; others take the mark."""
    e = tokens.Encoder(tokens.tokenizer_path("word_bpe_49k.json"))
    parts = ["alpha", "Beta", "\u00dcber", "\u0130x", "\u01c5", "\u4e2d\u6587", "a1", "it's", "x-y", "~", "a\u0301b", "\u00bd", "zeta,"]
    asked, library = [], e.library

    class Library:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **kw)
    e.library = Library()
    assert e.many(parts[:3]) == [np.array(library.encode(f" {p}", add_special_tokens=False).ids, "<u4").tobytes() for p in parts[:3]]
    assert asked[0] == "alpha Beta \u00dcber"
    assert e.many(parts) == [np.array(library.encode(f" {p}", add_special_tokens=False).ids, "<u4").tobytes() for p in parts]


def test_texts_are_scored_some_at_a_time(monkeypatch):
    """A batch's words are held for a slice of its texts, with the same values."""
    codes = np.unique(toxicity.subsequences(["grottig", "alpha"])[1])
    model = toxicity.Model(codes, np.linspace(-1, 1, len(codes)), -0.5, np.array([0.0, 1.0, 0.0]))
    texts = ["grottig alpha beta", None, "", "g r o t t i g", "x" * 900, *(f"word{i} grotti{i}" for i in range(200))]
    want = [toxicity.highest([t], model, 1)[0].tolist() for t in texts]
    sizes, cut = [], toxicity._highest
    monkeypatch.setattr(toxicity, "AT_ONCE", 300)
    monkeypatch.setattr(toxicity, "_highest", lambda some, *a: sizes.append(sum(len(t or "") for t in some)) or cut(some, *a))
    assert toxicity.highest(texts, model, 2).tolist() == want and toxicity.highest([], model, 2).shape == (0, toxicity.TOP)
    assert len(sizes) > 10 and max(sizes) < 1300


def test_plain_words_go_to_the_model_alone(monkeypatch):
    e = tokens.Encoder(tokens.tokenizer_path("word_bpe_49k.json"))
    library, seen = e.library, []

    class Watched:
        def encode_batch_fast(self, texts, **how):
            seen.extend(texts)
            return library.encode_batch_fast(texts, **how)
    monkeypatch.setattr(e, "library", Watched())
    texts = ["the Geungzuau Scheinheitzu\nÉtéàß ªº", "the geungzuau \u017ftone 12:30 it's"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want
    assert not any(w in t.lower() for t in seen for w in ("geungzuau", "scheinheitzu", "étéàß"))
    assert any("12:30" in t for t in seen)


def test_substring_levels_hold_one_python_worker_a_task(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20)) + " " + PASSAGE) for i in range(6)]
    keyed = spark.createDataFrame(rows, "doc_id long, text string").select(F.xxhash64("text").alias("k1"), "text")
    first = substrings.repeated(substrings._anchors(keyed, 35), "h")
    second = substrings.repeated(first.then(substrings._sides, {"h": "long", "k1": "long", "mark": "int"}), "h").frame()
    plan = second._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("MapInArrow") == 3 and "MapInPandas" not in plan      # one of each stage
    assert second.count() > 0
